import zlib

import numpy as np
import pyarrow as pa

from lotwise.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_compiled_rules(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = q.score_quality(docs.withColumn("score", docs.n_chars), labels).toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    assert ((got.score >= 0.7).astype(int) == got.predicted).all() and got.score.between(0, 1).all()
    test = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    assert (test.predicted == test.quality).mean() > 0.95
    model = q.train(docs, labels)
    assert 0 < len(model.rules) < 400
    text = docs.toPandas().set_index("doc_id").text
    x = q.text_statistics(pa.array([text[d] for d in got.doc_id], pa.large_string()))
    assert np.abs(model.predict(x) - got.score).max() < 1e-9


def test_statistics_do_not_depend_on_neighbours():
    texts = ["", "One two two. THREE!!", "a|b|c ### &&&", "é" * 50, "x y\n" * 100_000, ""]
    both = q.text_statistics(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        assert np.allclose(both[i], q.text_statistics(pa.array([t], pa.large_string()))[0])
    s = dict(zip(q.STATISTICS, both[1]))
    assert s["same_next"] == 0.25 and s["distinct_words"] == 0.75 and s["top_word"] == 0.5 and s["capitals"] == 0.5
    assert (both[0] == 0).all()


def test_nulls_ties_empty(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (3, "some words here", None), (3, "some words here", None)],
                                 "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in q.score_quality(docs, none).collect()] == [0.5] * 4
    one = spark.createDataFrame([(1, 1), (1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    assert q.keep_quality(docs, one, threshold=0.5).columns == docs.columns
    assert q.score_quality(docs.limit(0), one).count() == 0
