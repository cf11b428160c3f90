import numpy as np
from pyspark.sql import functions as F

from lotwise.llm import pii, trees


def _docs(spark, n):
    kinds = ["mail jo{0}@ex{1}.org now", "host 10.{1}.3.{2} up", "page {0} of 300 2 40", "tel +1 ({2}{2}) 555-0{0}", 'token = "0a{0}f9b8c7d6e5f4a3b2"', "card 4111 1111 1111 1111 x"]
    rows = [(i if i % 50 else None, kinds[i % 6].format(1000 + i, i % 200, i % 9 + 1) if i % 7 else None) for i in range(n)]
    return spark.createDataFrame(rows + rows[:20], "doc_id long, text string")


def test_every_candidate_of_every_document_is_fitted(spark):
    docs = _docs(spark, 9000)
    model = pii.train_spans(docs, trees=1)
    y = []
    for r in docs.where("text IS NOT NULL").select(F.xxhash64("doc_id").alias("key"), "text").collect():
        y += [label for i, (_, label, _) in enumerate(pii.training_rows(r.text, r.key % 97)) if (r.key + i) % 3 != 2]
    assert len(y) > 14_000
    p = (sum(y) + 1) / (len(y) + 2)
    assert np.isclose(model.boosted.start, np.log(p / (1 - p)), atol=1e-12)


def test_spark_and_driver_grow_the_same_trees(spark):
    docs = _docs(spark, 600).repartition(3)
    assert pii.train_spans(docs, trees=2, driver_points=0) == pii.train_spans(docs, trees=2)


def test_counted_cuts_and_trees_are_those_of_the_rows():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(3000, 4)), 1)
    y = (x[:, 0] + x[:, 1] > 0.5).astype(float)
    grid = [trees.quantile_cuts(x[:, j], 48) for j in range(4)]
    for j, c in enumerate(grid):
        v, n = np.unique(x[:, j], return_counts=True)
        assert np.allclose(trees.counted_cuts(v, n, 48), c, rtol=0, atol=1e-12)
    one = np.ones(len(x), np.int64)
    model = trees.boost_counted(pii._local_sums(trees.coded(x, grid), y, one, grid), grid, len(x), int(y.sum()), 8, 3)
    assert np.abs(model.predict(x) - trees.boost(x, y, 8, 3).predict(x)).max() < 1e-3
    v = trees.decoded(trees.coded(x, grid), grid)
    assert np.array_equal(model.predict(v), model.predict(x))
