"""Language identification by interpolated Kneser-Ney character models.

Texts become lower-case letters with one blank between words. Runs of ``ORDER``
characters are counted per language over all learning documents; lower orders
count distinct predecessors (continuation counts). With an absolute discount D
an order's probability is

    p(c | h) = (n(hc) - D) / n(h) + D * types(h) / n(h) * p(c | shorter h)

All languages' log probabilities of a run stand in one row of a table sorted by
the run's 64-bit hash, those of a language that never saw the run already
resolved; a second sorted table has the back-off weights of contexts. A text goes to the language
of the lowest cross-entropy per character. How sure that is comes from a logistic
model of the margins, fitted on documents left out of the counts; its negative
cases are the same documents scored without their own language. Decisions below
the threshold that keeps wrong ones to a set share are marked as rejected.
"""
from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import materialise
from .text import filled, mix64, pieces
from .trees import sigmoid

ORDER = 5
#: Documents whose crc32 div 4 is divisible by this calibrate and are not counted.
CALIBRATION_SHARE = 16
#: Different calibration documents, at most (the smallest hashes when there are more).
CALIBRATION_ROWS = 20_000
#: Share of wrong decisions among accepted ones on the calibration documents.
WRONG_SHARE = 0.01
#: (run, language) entries of the model that are broadcast at once; a larger model is split
#: into blocks, each scored in a pass of its own.
BLOCK_ENTRIES = 2_000_000
#: Distinct runs a task holds before it sends its counts on, and bytes of text it works on at a time.
HELD, PIECE = 200_000, 1 << 18
UNKNOWN = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BLANK = 32
_fold: list[np.ndarray] = []


def _folding() -> np.ndarray:
    """Lower-case code point of every letter, marks as they are, 0 for all else."""
    if not _fold:
        t = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 else i
            elif i > 127 and unicodedata.category(c)[0] == "M":
                t[i] = i
        _fold.append(t)
    return _fold[0]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Runs:
    """Characters of a batch: ``order - 1`` blanks before each row, blanks between words,
    one blank at the end of each row that has letters."""
    chars: np.ndarray
    at: np.ndarray  # places of the rows' own characters
    row: np.ndarray
    hashes: list[np.ndarray]  # [k - 1]: hash of the k characters up to each place


def runs_of(col: pa.Array, order: int = ORDER) -> Runs:
    texts = col.to_pylist()
    cps = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    own = _folding()[cps]
    before = np.r_[np.uint32(0), own[:-1]]
    before[1:][row[1:] != row[:-1]] = 0
    keep = (own != 0) | (before != 0)
    own, row = own[keep], row[keep]
    own = np.where(own == 0, np.uint32(_BLANK), own)
    at = np.arange(len(own)) + (row + 1) * (order - 1)
    chars = np.full(len(own) + (len(texts) + 1) * (order - 1), _BLANK, np.uint32)
    chars[at] = own
    code = mix64(chars.astype(np.uint64) + np.uint64(1))
    hashes = [code]
    for _ in range(order - 1):
        h = code.copy()
        h[1:] += hashes[-1][:-1] * _BASE
        hashes.append(h)
    return Runs(chars, at, row, hashes)


def _hash(grams: np.ndarray) -> np.ndarray:
    """The hash of ``runs_of`` for runs given as rows of code points."""
    h = np.zeros(len(grams), np.uint64)
    for j in range(grams.shape[1]):
        h = h * _BASE + mix64(grams[:, j].astype(np.uint64) + np.uint64(1))
    return h


def _points(grams: list[str], k: int) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, k)


def count_runs(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) of all runs of ``order`` characters of (lang, text) rows. Tasks
    combine equal runs before the shuffle."""
    def count(batches):
        held: dict[str, list] = {}

        def merged(got: list) -> tuple:
            h, p, n = (np.concatenate(x) for x in zip(*got))
            order_ = np.argsort(h, kind="stable")
            h, p, n = h[order_], p[order_], n[order_]
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
            return h[first], p[first], np.add.reduceat(n, first) if len(h) else n

        def out(lang, got):
            _, p, n = got
            s = p.astype("<u4").tobytes().decode("utf-32-le")
            return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(n), pa.string()),
                                               "gram": pa.array([s[i:i + order] for i in range(0, len(s), order)], pa.string()),
                                               "n": pa.array(n, pa.int64())})

        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            for lo, part in pieces(filled(b.column(1)), PIECE):
                r = runs_of(part, order)
                here = langs[lo:lo + len(part)]
                for lang in sorted(set(here.tolist())):
                    at = r.at[(here == lang)[r.row]]
                    h, i, n = np.unique(r.hashes[-1][at], return_index=True, return_counts=True)
                    p = r.chars[at[i][:, None] + np.arange(1 - order, 1)]
                    held.setdefault(lang, []).append((h, p, n))
                    if sum(len(x[0]) for x in held[lang]) > HELD:
                        held[lang] = [merged(held[lang])]
                        if len(held[lang][0][0]) > HELD // 2:
                            yield out(lang, held.pop(lang)[0])
        for lang, got in held.items():
            yield out(lang, merged(got))

    return docs.select("lang", "text").mapInArrow(count, "lang string, gram string, n bigint").where("gram <> ''") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The model as a table (order, gram, lang, logp, backoff): log probability of a run
    in a language that saw it, and log weight of the run as a context (NULL if it is none). The
    blanks before a text are contexts only. ``docs`` has lang and text."""
    counts = {order: materialise(count_runs(docs, order))}
    for k in range(order - 1, 0, -1):
        counts[k] = materialise(counts[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n")))
    alphabet = counts[1].agg(F.count_distinct("gram")).first()[0] + 1
    lower, weights, probs = None, {}, {}
    for k in range(1, order + 1):
        ones = counts[k].groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
        discount = ones.select("lang", F.greatest(F.lit(0.1), F.least(F.lit(0.95), F.coalesce(
            F.try_divide(F.col("n1").cast("double"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5)))).alias("d"))
        context = counts[k].groupBy("lang", F.substring("gram", 1, k - 1).alias("context")) \
            .agg(F.sum("n").alias("total"), F.count("*").alias("types")).join(discount, "lang") \
            .select("lang", "context", "d", "total", (F.col("d") * F.col("types") / F.col("total")).alias("weight"))
        p = counts[k].withColumn("context", F.substring("gram", 1, k - 1)).join(context, ["lang", "context"])
        if lower is None:
            p = p.withColumn("below", F.lit(1.0 / alphabet))
        else:
            p = p.withColumn("suffix", F.substring("gram", 2, k - 1)) \
                .join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
        lower = materialise(p.select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("weight") * F.col("below")).alias("p")))
        probs[k] = lower
        weights[k - 1] = context.select("lang", F.col("context").alias("gram"), F.log("weight").alias("backoff"))
    rows = weights[0].select(F.lit(0).alias("order"), "gram", "lang", F.lit(-float(np.log(alphabet))).alias("logp"), "backoff")
    for k in range(1, order + 1):
        part = probs[k].select(F.lit(k).alias("order"), "gram", "lang", F.log("p").alias("logp"))
        part = part.join(weights[k].withColumn("order", F.lit(k)), ["order", "gram", "lang"], "full") if k < order else part.withColumn("backoff", F.lit(None).cast("double"))
        rows = rows.unionByName(part.select("order", "gram", "lang", "logp", "backoff"))
    return materialise(rows)


@dataclass
class Block:
    """Sorted hash arrays of one block of the model."""
    languages: list[str]
    number: int
    blocks: int
    floor: np.ndarray  # log p of an unseen character after no context, by language
    keys: list[np.ndarray]  # [k - 1]: sorted hashes of known runs of k characters
    logp: list[np.ndarray]  # rows as keys, one column a language
    context_keys: list[np.ndarray]  # [k - 1]: sorted hashes of known contexts of k characters
    backoff: list[np.ndarray]


def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i = np.searchsorted(keys, h)
    i[i == len(keys)] = 0
    return i, keys[i] == h if len(keys) else np.zeros(len(h), bool)


def _log_probabilities(block: Block, upto: int, hashes, before, n: int) -> np.ndarray:
    """(n, languages) interpolated log p of characters; ``hashes(k, pick)`` and ``before(k, pick)``
    give the hashes of the run of k characters and of the k characters before the last one."""
    out = np.zeros((n, len(block.languages)), np.float32)
    left = np.arange(n)
    for k in range(upto, 0, -1):
        i, hit = _find(block.keys[k - 1], hashes(k, left))
        out[left[hit]] += block.logp[k - 1][i[hit]]
        left = left[~hit]
        if k > 1 and len(left):
            i, hit = _find(block.context_keys[k - 2], before(k - 1, left))
            out[left[hit]] += block.backoff[k - 2][i[hit]]
    out[left] += block.floor
    return out


def _shard(gram: Column, k: int, last: int, blocks: int) -> Column:
    """Block of the two characters of a run that end ``last`` places before its end."""
    at = k - last - 1
    return F.pmod(F.ascii(F.substring(gram, at, 1)) * 31 + F.ascii(F.substring(gram, at + 1, 1)), F.lit(blocks))


def model_blocks(model: DataFrame, order: int = ORDER, block_entries: int = BLOCK_ENTRIES):
    """Yield the model in blocks of about ``block_entries`` entries. A character belongs to the
    block of the two characters before it: all its runs of three and more characters and their contexts
    of two and more contain these. Shorter ones (at most the alphabet squared) are in every block."""
    languages = [r.lang for r in model.where("order = 0").select("lang").distinct().orderBy("lang").collect()]
    blocks = max(1, -(-model.count() // block_entries))
    col = {x: i for i, x in enumerate(languages)}

    def table(k: int, value: str, here: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = here.where(F.col(value).isNotNull()).select("gram", "lang", value).toArrow()
        p = _points(got["gram"].to_pylist(), k)
        h = _hash(p)
        keys, first, at = np.unique(h, return_index=True, return_inverse=True)
        m = np.full((len(keys), len(languages)), np.nan, np.float32)
        m[at, [col[x] for x in got["lang"].to_pylist()]] = got[value].to_numpy()
        return keys, m, p[first]

    for number in range(blocks):
        base = {r.lang: (r.logp, r.backoff) for r in model.where("order = 0").collect()}
        block = Block(languages, number, blocks, np.array([sum(base[x]) for x in languages], np.float32), [], [], [], [])
        for k in range(1, order + 1):
            rows = model.where(F.col("order") == k)
            if k < order:
                mine = rows if k < 2 or blocks == 1 else rows.where(_shard(F.col("gram"), k, 0, blocks) == number)
                keys, m, _ = table(k, "backoff", mine)
                block.context_keys.append(keys)
                block.backoff.append(np.nan_to_num(m, nan=0.0))  # a language without this context goes on to the shorter one
            mine = rows if k < 3 or blocks == 1 else rows.where(_shard(F.col("gram"), k, 1, blocks) == number)
            keys, m, p = table(k, "logp", mine)
            gap = np.isnan(m)
            some = np.flatnonzero(gap.any(axis=1))
            block.keys.append(keys)
            block.logp.append(m)
            if len(some):  # languages that never saw the run: its context's weight times the shorter run
                lower = np.zeros((len(some), len(languages)), np.float32)
                if k > 1:
                    i, hit = _find(block.context_keys[k - 2], _hash(p[some, :-1]))
                    lower[hit] = block.backoff[k - 2][i[hit]]
                lower += _log_probabilities(block, k - 1, lambda j, w: _hash(p[some[w], k - j:]), lambda j, w: _hash(p[some[w], k - 1 - j:k - 1]), len(some))
                m[some] = np.where(gap[some], lower, m[some])
        yield block


def _sums(block: Block, col: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, languages) sums of log p over the block's characters, and the rows' numbers of characters."""
    total = np.zeros((len(col), len(block.languages)))
    size = np.zeros(len(col), np.int64)
    for lo, part in pieces(col, PIECE):
        r = runs_of(part, order)
        size[lo:lo + len(part)] = np.bincount(r.row, minlength=len(part))
        at, row = r.at, r.row
        if block.blocks > 1:
            mine = (r.chars[at - 2].astype(np.int64) * 31 + r.chars[at - 1]) % block.blocks == block.number
            at, row = at[mine], row[mine]
        # Equal runs are looked up once.
        keys, first, back = np.unique(r.hashes[-1][at], return_index=True, return_inverse=True)
        place = at[first]
        lp = _log_probabilities(block, order, lambda k, w: r.hashes[k - 1][place[w]], lambda k, w: r.hashes[k - 1][place[w] - 1], len(place))
        for j in range(len(block.languages)):
            total[lo:lo + len(part), j] = np.bincount(row, lp[back, j], len(part))
    return total, size


def cross_entropies(docs: DataFrame, model: DataFrame, order: int = ORDER, block_entries: int = BLOCK_ENTRIES) -> tuple[DataFrame, list[str]]:
    """``docs`` (with text) with __sums (log p by language), __size (characters) and __letters, and the languages."""
    keep = [f for f in docs.schema.fields if f.name not in ("__sums", "__size", "__letters")]
    out = docs.select(*[F.col(f"`{f.name}`") for f in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", __sums array<double>, __size bigint, __letters boolean"
    languages: list[str] = []
    for block in model_blocks(model, order, block_entries):
        languages = block.languages
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared, added=block.number > 0):
            for b in batches:
                texts = filled(b.column(b.schema.get_field_index("text")))
                total, size = _sums(shared.value, texts, order)
                if added:
                    total += np.asarray(b.column(b.schema.get_field_index("__sums")).flatten(), float).reshape(total.shape)
                letters = [has_letter(t) for t in texts.to_pylist()]
                cols = {f.name: b.column(b.schema.get_field_index(f.name)) for f in keep}
                yield pa.RecordBatch.from_pydict(cols | {"__sums": pa.array(list(total), pa.list_(pa.float64())), "__size": pa.array(size),
                                                         "__letters": pa.array(letters, pa.bool_())})

        out = out.mapInArrow(run, schema)
        if block.number < block.blocks - 1:
            out = materialise(out)
    return out, languages


@dataclass
class Calibration:
    """Logistic model of being right, the languages' usual cross-entropies, and the threshold."""
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    usual: np.ndarray
    threshold: float


def _features(entropy: np.ndarray, size: np.ndarray, usual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best language, features): margin to the second best per character and in all, excess over
    the language's usual cross-entropy, length."""
    order = np.argsort(entropy, axis=1, kind="stable")
    best = order[:, 0]
    at = np.arange(len(entropy))
    first = entropy[at, best]
    second = entropy[at, order[:, 1]] if entropy.shape[1] > 1 else first
    margin = np.where(np.isfinite(second), second - first, 0.0)
    return best, np.column_stack([margin, np.log1p(margin * size), first - usual[best], np.log1p(size)])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (constant last) of a ridge logistic regression by damped Newton steps."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.r_[np.ones(x.shape[1]), 1e-3]
    loss = lambda v: np.logaddexp(0, np.where(y > 0.5, -1, 1) * (z @ v)).sum() + 0.5 * penalty @ (v * v)
    for _ in range(rounds):
        p = sigmoid(z @ w)
        g = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), g)
        rate = 1.0
        while loss(w - rate * step) > loss(w) and rate > 1e-6:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-9:
            break
    return w


def calibrate(entropy: np.ndarray, size: np.ndarray, truth: np.ndarray, wrong_share: float = WRONG_SHARE) -> Calibration:
    """Fit on documents (cross-entropies by language, characters, index of the true language). Each
    document also counts without its own language, where any choice is wrong."""
    n_lang = entropy.shape[1] if entropy.ndim == 2 else 0
    usual = np.zeros(n_lang)
    for j in range(n_lang):
        own = truth == j
        usual[j] = np.average(entropy[own, j], weights=size[own]) if own.any() else np.nan
    if n_lang:
        usual = np.where(np.isnan(usual), np.nanmean(usual) if np.isfinite(usual).any() else 0.0, usual)
    if not len(truth):  # nothing to learn from: a margin of 0.3 or 20 in all makes a choice sure
        return Calibration(np.array([2.0, 1.0, -1.0, 0.0, -1.0]), np.zeros(4), np.ones(4), usual, 0.5)
    best, x = _features(entropy, size, usual)
    y = (best == truth).astype(float)
    if n_lang > 1:
        blind = entropy.copy()
        blind[np.arange(len(truth)), truth] = np.inf
        x = np.vstack([x, _features(blind, size, usual)[1]])
        y = np.r_[y, np.zeros(len(truth))]
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    w = _logistic((x - centre) / scale, y)
    p = sigmoid(np.column_stack([(x - centre) / scale, np.ones(len(x))]) @ w)
    order = np.argsort(-p, kind="stable")
    wrong = np.cumsum(1 - y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(wrong <= wrong_share)
    threshold = float(p[order[good[-1]]]) if len(good) else 1.0
    return Calibration(w, centre, scale, usual, threshold)


def _fold_of(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string"))


def identify_languages(docs: DataFrame, order: int = ORDER, calibration_rows: int = CALIBRATION_ROWS, wrong_share: float = WRONG_SHARE,
                       block_entries: int = BLOCK_ENTRIES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: (doc_id, held_out, lang_pred, score, rejected, cross_entropy).

    Learns from texts with a non-NULL language in rows whose crc32(id as text) mod 4 is not 2
    (held_out marks the others; rows with a NULL id are neither learned from nor held out); one in
    CALIBRATION_SHARE of the learning rows calibrates instead of being counted, ``calibration_rows`` at
    most. ``lang_pred`` is the language of the lowest cross-entropy (nats a character; ties: the
    smaller name), ``score`` the calibrated probability that it is right, ``rejected`` whether
    that lies below the threshold. A text that is NULL, empty or without a letter gets 'und', score 0,
    rejected, no cross-entropy; so does every text when there is nothing to learn from. Rows that
    repeat get equal results; an empty table gives an empty result; other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    fold = _fold_of(F.col("doc_id"))
    learn = base.where("lang IS NOT NULL").where(F.coalesce(fold % 4 != 2, F.lit(False)))
    aside = F.floor(fold / 4) % CALIBRATION_SHARE == 0
    model = train(learn.where(~aside), order)
    rows = base.select("doc_id", F.coalesce(fold % 4 == 2, F.lit(False)).alias("held_out"), "text")
    if model.where("order = 0").isEmpty():
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"),
                           F.lit(None).cast("double").alias("cross_entropy"))
    # The bound is found on hashes alone; the texts below it stay spread over all partitions.
    hashed = learn.where(aside).withColumn("__hash", F.xxhash64("doc_id", "text", "lang"))
    last = hashed.select("__hash").distinct().orderBy("__hash").limit(calibration_rows).agg(F.max("__hash")).first()[0]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = hashed.where(F.col("__hash") <= F.lit(last)).repartition(parts, "__hash").dropDuplicates(["__hash"])
    seen, languages = cross_entropies(sample, model, order, block_entries)
    got = seen.where("__letters").select("lang", "__sums", "__size").collect()
    place = {x: i for i, x in enumerate(languages)}
    got = [r for r in got if r.lang in place]
    size = np.array([r["__size"] for r in got], float)
    entropy = -np.array([r["__sums"] for r in got]).reshape(len(got), len(languages)) / size[:, None]
    fitted = calibrate(entropy, size, np.array([place[r.lang] for r in got], np.int64), wrong_share)
    scored, _ = cross_entropies(rows, model, order, block_entries)

    # Decisions are plain columns over the sums, so texts pass through Python once.
    size = F.greatest(F.col("__size"), F.lit(1)).cast("double")
    scored = scored.withColumn("__entropy", F.transform("__sums", lambda x: -x / size))
    scored = scored.withColumn("__sorted", F.array_sort("__entropy"))
    first, second = F.col("__sorted")[0], F.col("__sorted")[min(1, len(languages) - 1)]
    place = F.array_position("__entropy", first).cast("int")  # ties: the smaller name
    margin, pick = second - first, lambda values: F.element_at(F.array(*[F.lit(x) for x in values]), place)
    x = [margin, F.log1p(margin * size), first - pick([float(u) for u in fitted.usual]), F.log1p(size)]
    z = F.lit(float(fitted.weights[-1]))
    for value, w, c, d in zip(x, fitted.weights, fitted.centre, fitted.scale):
        z = z + F.lit(float(w)) * (value - F.lit(float(c))) / F.lit(float(d))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(35.0)), F.lit(-35.0))))
    ok = F.col("__letters")
    return scored.withColumn("__p", p).select(
        "doc_id", "held_out", F.when(ok, pick(languages)).otherwise(F.lit(UNKNOWN)).alias("lang_pred"), F.when(ok, F.col("__p")).otherwise(F.lit(0.0)).alias("score"),
        (~ok | (F.col("__p") < F.lit(float(fitted.threshold)))).alias("rejected"), F.when(ok, first).alias("cross_entropy"))
