from pyspark.sql import functions as F

from lotwise.plans import views
from lotwise.sources.kvtext import write_json_by_page

D = "/root/testdata/sf0.001"


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_suppliers_are_broadcast_and_tasks_follow_the_rows(spark, monkeypatch):
    """A large input's last join has as many tasks as its rows ask for, and narrow rows are not shuffled by supplier."""
    rows = views.table(spark, D, "lineitem").count()
    before = sorted(views.raw_listing(spark, D).collect(), key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(views, "TASK_ROWS", rows // 50, raising=False)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        raw = views.raw_listing(spark, D)
        assert raw.rdd.getNumPartitions() >= 50
        assert "BroadcastHashJoin" in _physical(raw)
        monkeypatch.setattr(views, "BROADCAST_SUPPLIERS", 0, raising=False)
        shuffled = views.raw_listing(spark, D)
        assert "BroadcastHashJoin" not in _physical(shuffled)
        assert sorted(raw.collect(), key=str) == before == sorted(shuffled.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_prices_and_discounts_are_shuffled_as_what_the_listing_shows(spark):
    rows = [(119.99, 0.05), (120.0, 0.049), (59.99, 0.004), (None, 0.1), (100.0, None)]
    got = spark.createDataFrame(rows, "price double, discount double").select(*views._priced(F.col("price"), F.col("discount")))
    assert [tuple(r) for r in got.collect()] == [(119, 1, 2), (120, None, 0), (59, None, 1), (None, None, 2), (100, None, 0)]


def test_json_by_page_is_written_compressed(spark, tmp_path):
    rows = spark.createDataFrame([(i // 10, i, "same text " * 20) for i in range(100)], "page int, idx int, Title string")
    write_json_by_page(rows, f"{tmp_path}/pages", compression="gzip")
    files = [f for f in tmp_path.rglob("*.json*") if not f.name.startswith(".")]
    assert files and all(f.name.endswith(".json.gz") for f in files) and {f.parent.name for f in files} == {f"page={i}" for i in range(10)}
    back = spark.read.schema("idx int, Title string, page int").json(f"{tmp_path}/pages").select("page", "idx", "Title")
    assert sorted(back.collect()) == sorted(rows.collect())
