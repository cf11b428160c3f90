from lotwise import session
from lotwise.operators.dedup import dedup_by_key

from .conftest import raw_rows

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_rows_are_packed_before_they_are_sorted(spark):
    """The grouping's sort holds the key and one packed row, not the input's columns."""
    df = raw_rows(spark, [{"VIN": "A", "Title": "b", "MPG": None}, {"VIN": "A", "Title": "a"}, {"VIN": None, "Title": "c"}, {"VIN": None, "Title": "c"}])
    got = dedup_by_key(df)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "partial_min(__row" in plan
    assert sorted((str(r.VIN), r.Title, r.MPG) for r in got.collect()) == [("A", "a", None), ("None", "c", None)]


def test_every_query_sets_the_method_limit(spark):
    import __spark_entry__ as entry

    spark.conf.unset(LIMIT)
    try:
        entry.queries()["price_category"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(LIMIT) == "8000" == session.BASE_CONF[LIMIT]
    finally:
        spark.conf.set(LIMIT, "8000")
