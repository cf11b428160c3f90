"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Token counts are added up to one row per (source, language, topic) cell. The
cell weights are raked until the expected sample, in which no cell can give more
than it holds, meets the target marginals along each dimension: cells taken whole
count with their tokens and the others are raked on. A document of a cell is kept
with the probability that gives the cell its weight. All of it is DataFrame
operations; the random number of a document is a hash of its id.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise

#: Raking ends when a round finds no marginal off by more than TOLERANCE of the
#: sample, looked at after every STEP rounds; targets that no weights meet end it after ROUNDS.
ROUNDS, STEP, TOLERANCE = 96, 4, 1e-4
#: So many cells (counted) are raked by one task, which needs no shuffle; more of them by windows over shuffled cells.
ONE_TASK_CELLS = 100_000
#: Share of all tokens to keep, and the powers of the observed shares that give the target marginals.
KEEP = 0.5
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
SALT = "mix"


def token_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def topic_of(text: Column, tokens: Column) -> Column:
    """A content class of a document, the third dimension of the mix."""
    return F.when(tokens == 0, "empty").when(F.contains(text, F.lit(" | ")), "listing").when(F.contains(text, F.lit("!!")), "shout") \
        .when(tokens < 64, "note").when(tokens < 512, "article").otherwise("long")


def _key(c: Column) -> Column:
    """A text key in which NULL differs from every value."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _with_cell(docs: DataFrame, source_col: str, lang_col: str, text_col: str, topic: Column | None) -> DataFrame:
    """``docs`` plus __n (tokens), __topic and the cell keys __source, __lang, __topic_key."""
    counted = docs.withColumn("__n", token_count(F.col(text_col).cast("string")))
    named = counted.withColumn("__topic", topic if topic is not None else topic_of(F.col(text_col).cast("string"), F.col("__n")))
    return named.withColumns({"__source": _key(F.col(source_col)), "__lang": _key(F.col(lang_col)), "__topic_key": _key(F.col("__topic"))})


_DIMS = {"source": "__source", "lang": "__lang", "topic": "__topic_key"}


def _wishes(cells: DataFrame, dim: str, given: Mapping[str, float] | None, power: float) -> DataFrame:
    """(key, n, w): a value's tokens, and its given weight (values without one get none), else its tempered tokens."""
    key = _DIMS[dim]
    seen = cells.groupBy(key).agg(F.sum("n").alias("n"))
    if given is None:
        wish = F.pow(F.col("n").cast("double"), F.lit(power))
    else:
        pairs = F.create_map(*[x for k, v in given.items() for x in (F.lit("" if k is None else f"={k}"), F.lit(float(v)))]) if given else F.create_map()
        wish = F.coalesce(F.element_at(pairs.cast("map<string,double>"), F.col(key)), F.lit(0.0))
    return materialise(seen.select(key, "n", wish.alias("w")))


def _level(rows: DataFrame, amount: float) -> float:
    """c with sum(min(n, c * w)) = ``amount``, or one that takes all. The rows taken
    whole only grow from step to step; each step is one aggregate row."""
    live = rows.where("w > 0 AND n > 0")
    c, last = 0.0, -1
    while True:
        whole = F.lit(c) * F.col("w") >= F.col("n")
        r = live.agg(F.sum(F.when(whole, F.col("n")).otherwise(0)).cast("double").alias("taken"), F.sum(F.when(whole, 0.0).otherwise(F.col("w"))).alias("free"),
                     F.sum(whole.cast("int")).alias("count")).first()
        if r["count"] is None or r["count"] == last or not r["free"]:
            return c
        c, last = max(0.0, amount - r["taken"]) / r["free"], r["count"]


def rake(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, temper: Mapping[str, float] = TEMPER, rounds: int = ROUNDS,
         keep: float = KEEP, source_col: str = "source", lang_col: str = "lang", text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """One row per cell: keys, n (tokens), docs, w (the cell's share of the expected
    sample), p (probability of keeping a document, also the share of its tokens).

    The sample has ``keep`` of all tokens, or what the values with a target hold if
    that is less. A value that holds less than its target is taken whole and the
    targets of its dimension's other values are scaled up. A round scales the
    weights along each dimension in turn by target over min(n, weight) summed, so
    cells that are taken whole leave their part to the others. Targets that exclude
    each other end after ``rounds`` with the dimension raked last met;
    ``marginals`` tells what was reached.

    The cells are the product of three short lists and are pre-aggregated before any
    shuffle, so a source with a third of all rows is a few rows here; sums along a
    dimension are windows over cells, which keeps the plan of a round linear, and
    every ``STEP`` rounds the cells are written and read again. Up to
    ``ONE_TASK_CELLS`` cells are raked in one task, with equal results.
    """
    keys = list(_DIMS.values())
    cells = materialise(_with_cell(docs, source_col, lang_col, text_col, topic).groupBy(*keys).agg(F.sum("__n").alias("n"), F.count("*").alias("docs")))
    wishes = {d: _wishes(cells, d, (targets or {}).get(d), temper.get(d, 1.0)) for d in _DIMS}
    total, count = cells.agg(F.sum("n").cast("double"), F.count("*")).first()
    total = total or 0.0

    def near(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if count <= ONE_TASK_CELLS else df

    amount = min([keep * total, *(w.where("w > 0").agg(F.sum("n").cast("double")).first()[0] or 0.0 for w in wishes.values())])
    state = cells.withColumn("w", F.col("n") * F.lit(float(keep)))
    for d, key in _DIMS.items():
        want = F.least(F.col("n").cast("double"), F.lit(_level(wishes[d], amount)) * F.col("w"))
        state = state.join(wishes[d].select(key, want.alias(f"want_{d}")), key)
    state = near(materialise(near(state)))
    for _ in range(0, rounds if amount > 0 else 0, STEP):
        for _ in range(STEP):
            state = _round(state, amount)
        state = near(materialise(state))
        if state.agg(F.max("off")).first()[0] < TOLERANCE:
            break
    given = F.least(F.col("n").cast("double"), F.col("w"))
    return materialise(state.select(*keys, "n", "docs", F.when(F.lit(amount > 0), given / F.lit(amount or 1.0)).otherwise(0.0).alias("w"),
                                    F.when(F.col("n") > 0, given / F.col("n")).otherwise(0.0).alias("p")))


def _round(state: DataFrame, amount: float) -> DataFrame:
    """The cells after one round, and ``off``: how far a marginal was from its target, as a share of the sample."""
    off = F.lit(0.0)
    for d, key in _DIMS.items():
        state = state.withColumn("now", F.sum(F.least(F.col("n").cast("double"), F.col("w"))).over(Window.partitionBy(key)))
        state = state.withColumns({f"off_{d}": F.abs(F.col("now") - F.col(f"want_{d}")) / F.lit(amount),
                                   "w": F.when(F.col("now") > 0, F.col("w") * F.col(f"want_{d}") / F.col("now")).otherwise(0.0)})
        off = F.greatest(off, F.col(f"off_{d}"))
    return state.withColumn("off", off).drop("now", *(f"off_{d}" for d in _DIMS))


def marginals(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, temper: Mapping[str, float] = TEMPER) -> DataFrame:
    """What ``rake`` reached: dimension, value (as a key), supply (share of all
    tokens), target (as wished) and reached (share of the expected sample)."""
    out = None
    for d, key in _DIMS.items():
        wish = _wishes(cells, d, (targets or {}).get(d), temper.get(d, 1.0))
        total = wish.agg(F.sum("n").alias("all"), F.sum("w").alias("wished"))
        own = cells.groupBy(key).agg(F.sum("w").alias("reached")).join(wish, key).crossJoin(F.broadcast(total)) \
            .select(F.lit(d).alias("dimension"), F.col(key).alias("value"), (F.col("n") / F.col("all")).alias("supply"),
                    (F.col("w") / F.col("wished")).alias("target"), "reached")
        out = own if out is None else out.unionAll(own)
    return out


def uniform(id_col: Column) -> Column:
    """A number in [0, 1) fixed by the id: 52 bits of its MD5; NULL gets one like any id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(SALT + ":"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(docs: DataFrame, cells: DataFrame, source_col: str = "source", lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
        topic: Column | None = None) -> DataFrame:
    """``docs``, all rows and columns, plus __n, __topic, __w, __p and __sampled of each document.

    NULL source or language is a value of its own; NULL and empty texts have no
    tokens, the topic ``empty`` and the probability 0; rows that share an id share
    their fate; an empty table gives no rows. The few cells are joined as they are
    (a broadcast only where adaptive execution measures them as small)."""
    keys = list(_DIMS.values())
    c = cells.select(*keys, F.col("w").alias("__w"), F.col("p").alias("__p"))
    return _with_cell(docs, source_col, lang_col, text_col, topic).join(c, keys).drop(*keys) \
        .withColumn("__sampled", uniform(F.col(id_col)) < F.col("__p"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, weight (of its
    cell) and probability (to 9 digits), sampled."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return mix(slim, rake(slim, **options)).select("doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__n").alias("n_tokens"),
                                                   F.round("__w", 9).alias("weight"), F.round("__p", 9).alias("probability"), F.col("__sampled").alias("sampled"))


def mixture_sql(rounds: int = ROUNDS, keep: float = KEEP, temper: Mapping[str, float] = TEMPER) -> str:
    """The same as DuckDB SQL over ``documents``: the rounds are written out, and weights stay as they are once ``off`` was small enough."""
    dims = ["source", "lang", "topic"]
    steps, last = [], "start"
    for i in range(rounds):
        if i % STEP == 0:
            steps.append(f"go{i // STEP} AS MATERIALIZED (SELECT max(off) >= {TOLERANCE} AS go FROM {last})")
        still = f"(SELECT go FROM go{i // STEP})"
        for d in dims:
            name = f"r{i}_{d}"
            was = "0.0" if d == "source" else "off"
            steps.append(f"{name} AS MATERIALIZED (SELECT * EXCLUDE (now) REPLACE (CASE WHEN NOT {still} THEN w WHEN now > 0 THEN w * want_{d} / now ELSE 0 END AS w, "
                         f"CASE WHEN NOT {still} THEN off ELSE greatest({was}, abs(now - want_{d}) / (SELECT amount FROM whole)) END AS off) "
                         f"FROM (SELECT *, sum(least(n::DOUBLE, w)) OVER (PARTITION BY {d}) AS now FROM {last}))")
            last = name
    wish = ", ".join(f"""
wish_{d} AS MATERIALIZED (SELECT {d}, sum(n) AS n, pow(sum(n)::DOUBLE, {temper[d]}) AS w FROM cells GROUP BY {d}),
level_{d} AS MATERIALIZED (SELECT max(c) AS c FROM (SELECT ((SELECT amount FROM whole) - coalesce(taken, 0)) / free AS c, r FROM (
  SELECT w / n AS r, sum(n) OVER above AS taken, sum(w) OVER below AS free FROM wish_{d} WHERE n > 0
  WINDOW above AS (ORDER BY w / n DESC, {d} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         below AS (ORDER BY w / n DESC, {d} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))) WHERE c * r < 1)""" for d in dims)
    return f"""
WITH counted AS MATERIALIZED (
  SELECT doc_id, source, lang, text, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
named AS MATERIALIZED (
  SELECT doc_id, source, lang, n_tokens, CASE WHEN n_tokens = 0 THEN 'empty' WHEN contains(text, ' | ') THEN 'listing' WHEN contains(text, '!!') THEN 'shout'
    WHEN n_tokens < 64 THEN 'note' WHEN n_tokens < 512 THEN 'article' ELSE 'long' END AS topic FROM counted),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS n FROM named GROUP BY ALL),
whole AS MATERIALIZED (SELECT {keep} * sum(n)::DOUBLE AS amount FROM cells),{wish},
start AS MATERIALIZED (SELECT c.*, n * {keep}::DOUBLE AS w, 1.0::DOUBLE AS off, {", ".join(
        f"(SELECT least(t.n::DOUBLE, (SELECT c FROM level_{d}) * t.w) FROM wish_{d} t WHERE t.{d} IS NOT DISTINCT FROM c.{d}) AS want_{d}" for d in dims)} FROM cells c),
{", ".join(steps)},
final AS (SELECT *, least(n::DOUBLE, w) / (SELECT amount FROM whole) AS share, CASE WHEN n > 0 THEN least(n::DOUBLE, w) / n ELSE 0 END AS p FROM {last})
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(f.share, 9) AS weight, round(f.p, 9) AS probability,
  ('0x' || substr(md5('{SALT}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 < f.p AS sampled
FROM named d JOIN final f ON d.source IS NOT DISTINCT FROM f.source AND d.lang IS NOT DISTINCT FROM f.lang AND d.topic = f.topic"""
