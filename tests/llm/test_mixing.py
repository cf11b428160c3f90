import duckdb
import pytest
from pyspark.sql import functions as F

from lotwise.llm import mixing as m

SF = "/root/testdata/sf0.01"


def test_equals_sql_and_meets_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = m.mixture(docs.withColumn("w", F.lit(1)).withColumn("topic", F.lit("clash"))).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(m.mixture_sql()).df().sort_values("doc_id").reset_index(drop=True)
    for c in got.columns:
        assert (got[c] == want[c]).all(), c
    reached = got.assign(given=got.probability * got.n_tokens / (m.KEEP * got.n_tokens.sum()))
    cells = got.drop_duplicates(["source", "lang", "topic"])
    for d, power in m.TEMPER.items():
        supply = got.groupby(d).n_tokens.sum() / (m.KEEP * got.n_tokens.sum())
        wish = supply ** power
        target, whole = wish / wish.sum(), supply < 0
        while (target > supply).any():  # a value that holds less than its target is taken whole
            whole |= target > supply
            target = supply.where(whole, (1 - supply[whole].sum()) * wish / wish[~whole].sum())
        assert (reached.groupby(d).given.sum() - target).abs().max() < 2 * m.TOLERANCE
        assert (cells.groupby(d).weight.sum() - target).abs().max() < 2 * m.TOLERANCE
    assert abs((got.probability * got.n_tokens).sum() / got.n_tokens.sum() - m.KEEP) < m.TOLERANCE
    assert abs(got.sampled.mean() - got.probability.mean()) < 0.05
    plan = m.mixture(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_given_targets_nulls_and_ties(spark):
    rows = [(i, "w " * 20, "a" if i % 3 else None, "en" if i % 2 else "fr") for i in range(60)] + [(None, None, None, None), (7, "", "a", "en"), (7, "", "a", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = m.mixture(docs, targets={"source": {"a": 0.5, None: 0.5}, "lang": {"en": 1.0}}, temper={"topic": 1.0}, keep=0.25).toPandas()
    assert len(got) == 63
    assert set(got[got.lang == "fr"].probability) == {0.0} and not got[got.n_tokens == 0].sampled.any()
    en = got[(got.lang == "en") & (got.n_tokens > 0)]
    assert en[en.source.isna()].weight.iloc[0] == pytest.approx(0.5) and en[en.source == "a"].weight.iloc[0] == pytest.approx(0.5)
    assert (en.probability * en.n_tokens).sum() == pytest.approx(0.25 * got.n_tokens.sum())


def test_empty_and_keep_all(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "en"), (2, "c", "s", "de")], "doc_id long, text string, source string, lang string")
    assert m.mixture(docs.limit(0)).count() == 0
    assert all(r.sampled for r in m.mixture(docs, keep=1.0).collect())


def test_cells_taken_whole_leave_their_part_to_others(spark):
    """Cell (a, en) cannot give what its weight asks for; (a, fr) and (b, en) make up for it."""
    size = {("a", "en"): 20, ("a", "fr"): 380, ("b", "en"): 500, ("b", "fr"): 100}
    docs = spark.createDataFrame([(i, "w " * 10, s, g) for (s, g), n in size.items() for i in range(n // 10)], "doc_id long, text string, source string, lang string")
    cells = m.rake(docs, targets={"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "fr": 0.5}})
    got = {(r["__source"][1:], r["__lang"][1:]): r.w * 500 for r in cells.collect()}
    assert got["a", "en"] == pytest.approx(20, abs=0.2) and all(0 <= got[c] <= size[c] + 1e-9 for c in size)
    told = {(r.dimension, r.value): r.reached for r in m.marginals(cells, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "fr": 0.5}}).collect()}
    assert told["source", "=a"] == pytest.approx(0.5, abs=1e-3) and told["lang", "=en"] == pytest.approx(0.5, abs=1e-3)


def test_long_text_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "word " * 400_000, "s", "en", 5), (2, "a b", None, None, 6), (None, None, "s", "en", 7)],
                                 "doc_id long, text string, source string, lang string, weight int")
    got = {r.doc_id: r for r in m.mixture(docs).collect()}
    assert got[1].n_tokens == 400_000 and got[1].topic == "long" and len(got) == 3 and got[None].probability == 0


def test_many_cells_are_raked_by_shuffled_windows_with_equal_results(spark, monkeypatch):
    rows = [(i, "w " * (10 + i % 90), f"s{i % 7}", "en" if i % 4 else "fr") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    one = sorted(tuple(r) for r in m.mixture(docs).collect())
    monkeypatch.setattr(m, "ONE_TASK_CELLS", 0)
    assert sorted(tuple(r) for r in m.mixture(docs).collect()) == one
