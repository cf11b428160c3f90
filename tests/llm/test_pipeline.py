import corpus_pipeline as cp
from lotwise.llm import mixing, quality
from lotwise.llm.tables import materialise
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_pii import plain
from tests.llm.test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.01"


def test_each_stage_on_all_that_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    out = {}
    for name, stage in cp.STAGES:
        docs = materialise(stage(spark, docs, SF))
        assert name == "mixing" or docs.columns == columns
        out[name] = {r.doc_id: r for r in docs.collect()}
    score = {r.doc_id: r.predicted for r in quality.score_quality(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    kept = {d for d in rows if score[d] == 1}
    assert set(out["quality"]) == kept
    comp = brute_components(sorted((d, brute_fp(rows[d].text)) for d in kept), 4)
    kept = {d for d in kept if comp[d] == d}
    assert set(out["near_duplicates"]) == kept
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept -= {d for d, _, _ in leaks([(d, rows[d].text) for d in kept], items)}
    assert set(out["decontamination"]) == kept
    assert set(out["personal_data"]) == kept
    for d, r in out["personal_data"].items():
        assert r.n_chars == len(r.text) and not plain(r.text)
        if r.text != rows[d].text:
            assert "[" in r.text
        else:
            assert r == rows[d]
    before = spark.createDataFrame(list(out["personal_data"].values()), schema=spark.read.parquet(f"{SF}/documents.parquet").schema)
    want = {r.doc_id for r in mixing.mixture(before).collect() if r.sampled}
    assert set(out["mixing"]) == want and 0 < len(want) < len(kept)


def test_run_and_empty_table(spark, tmp_path):
    assert cp.run(spark, "/root/testdata/sf0.001").count() > 0
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
