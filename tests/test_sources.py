import os
import uuid

import pytest

from pyspark.sql import functions as F

from lotwise.session import scratch_path
from lotwise.sources import jdbc, kvtext, lake, web


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_kv_text_files_and_sidecars(spark):
    root = scratch_path(spark, f"kv-{uuid.uuid4().hex}")
    _write(f"{root}/1/1.txt", "Title: 2017 Pine Hauler\nCash Price: $28,750\n\nNote: a: b\nTitle: 2018 Pine Hauler\n"
                              "Features: A; B;\n")
    _write(f"{root}/1/1_meta.json", '{\n "crawl_time": "2025-03-17 10:00:00",\n "page": 1,\n "index": 1\n}')
    _write(f"{root}/1/2.txt", "Title: Kia Soul 2020\nVIN: X\n")
    _write(f"{root}/1/1_meta.txt", "Title: ignored\n")
    recs = kvtext.read_kv_text(spark, root.replace("file:", ""))
    rows = {r["idx"]: r for r in recs.collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["record"]["Title"] == "2018 Pine Hauler"     # last duplicate wins
    assert rows[1]["record"]["Note"] == "a: b"                 # split at the first ':'
    nested = kvtext.kv_to_nested(recs).filter("idx = 2").first()
    assert nested["price_info"]["cash_price"] == "N/A" and nested["features"] == []
    assert dict(nested["overview"]) == {"VIN": "X"}
    side = kvtext.read_sidecars(spark, root.replace("file:", ""))
    j = kvtext.attach_sidecar(recs, side)
    got = {r["idx"]: r["metadata"] for r in j.collect()}
    assert got[1]["page"] == 1 and got[2] is None


def test_overview_classifier_order(spark):
    items = ["Exterior: Harbor Mist", "88,114 miles", "7 miles away", "Elmstead, OR (7 miles away)",
             "AWD", "1.9L Flat-3 Gas", "Listed 57 days ago", "VIN: ABC", "Exterior: Black"]
    df = spark.createDataFrame([(items,)], "items array<string>")
    r = web.overview_classify(df).first()
    assert r["Exterior"] == "Black" and r["Mileage"] == "88,114 miles" and r["Drivetrain"] == "AWD"
    assert r["Engine"] == "1.9L Flat-3 Gas" and r["Listed Since"] == "57 days ago" and r["VIN"] == "ABC"
    assert r["Location"] == "Elmstead, OR" and r["Interior"] == "N/A"


def test_links_cap_and_title(spark):
    html = "".join(f'<a data-test="cardLinkCover" href="/car/{i}">x</a>' for i in range(40)) + \
        '<a href="/other">o</a><h1 class="t">A &amp; B</h1>'
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id long, html string")
    links = web.listing_links(pages, cap=30)
    assert links.count() == 30 and links.agg(F.max("pos")).first()[0] == 29
    titles = {r[0]: r[1] for r in web.page_title_fallback(pages).collect()}
    assert titles == {1: "A & B", 2: "No Title"}


def test_records_that_do_not_parse_are_left_out_and_reported(spark):
    src, base = scratch_path(spark, f"src-{uuid.uuid4().hex}"), scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    spark.createDataFrame([('{"VIN": "A", "page": 1}',), ('{"VIN": "B", "pa',), ('{"VIN": "C", "page": 2}',)], "value string").write.text(src)
    bad = lake.load_json_lines(spark, src, base, "VIN string, page int").collect()
    assert [r.record for r in bad] == ['{"VIN": "B", "pa'] and bad[0].file_path
    assert sorted(r.VIN for r in spark.read.json(base).collect()) == ["A", "C"]
    day = spark.read.json(base).first().load_date
    m = lake.load_manifest(spark, base, "src", str(day)).collect()
    assert sorted((r.page, r.rows, r.loaded_files_count) for r in m) == [(1, 1, 1), (2, 1, 1)]


def test_fallback_keeps_the_whole_reason(spark):
    def fail_first(df, path):
        if path == "first":
            raise OSError("")
        df.write.parquet(path)
    out = lake.write_with_fallback(spark.range(2).toDF("x"), "first", scratch_path(spark, f"fb-{uuid.uuid4().hex}"), fail_first).first()
    assert out.storage_type == "local_fallback" and out.reason == "OSError: "


def test_only_storage_failures_select_the_fallback(spark, tmp_path):
    df = spark.createDataFrame([("a", "1")], "Title string, page string").withColumn("page", F.col("page").cast("int"))
    write = lambda x, p: x.write.mode("append").parquet(p)
    got = lake.write_with_fallback(df, "no-such-store://x/y", str(tmp_path / "f"), writer=write).first()
    assert got.storage_type == "local_fallback" and spark.read.parquet(str(tmp_path / "f")).count() == 1
    broken = df.withColumn("n", F.expr("assert_true(page < 0, 'bad input')"))
    with pytest.raises(Exception, match="bad input"):
        lake.write_with_fallback(broken, str(tmp_path / "p"), str(tmp_path / "g"), writer=write)
    with pytest.raises(Exception):
        lake.write_with_fallback(spark.read.schema("a string").parquet(str(tmp_path / "f")).withColumn("n", F.col("nothing")), str(tmp_path / "p"), str(tmp_path / "g"), writer=write)
    assert not (tmp_path / "g").exists()


def test_bulk_sidecars_belong_by_page_and_index(spark, tmp_path):
    spark.createDataFrame([("t1", 1, 2), ("t2", 3, 4)], "crawl_time string, page int, index int").write.json(str(tmp_path / "side"))
    records = spark.createDataFrame([("/r/1/2.txt",), ("/r/3/5.txt",)], "source_path string")
    got = {r.source_path: r.metadata for r in kvtext.attach_sidecar(records, kvtext.read_sidecars(spark, str(tmp_path / "side"), bulk_root="/r")).collect()}
    assert got["/r/1/2.txt"].crawl_time == "t1" and got["/r/3/5.txt"] is None


def _derby(spark, name):
    return f"jdbc:derby:{scratch_path(spark, name + uuid.uuid4().hex)}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_key_ranges_and_a_copy_that_goes_on(spark):
    (src, props), (dst, _) = _derby(spark, "src"), _derby(spark, "dst")
    rows = [(f"1LW{i:05d}", i % 7) for i in range(700)] + [(None, 1), (None, 1), ("1LW00001", 9), ("1LW00001", 9), ("it's", 3)]
    df = spark.createDataFrame(rows, "VIN string, n int")
    jdbc.append_jdbc(df, src, "Cars", props)
    pieces = jdbc.key_ranges(spark, src, "Cars", "VIN", props, 5)
    counts = jdbc.piece_counts(spark, src, "Cars", pieces, props)
    assert sum(counts) == len(rows)
    jdbc.append_jdbc(df.where("VIN LIKE '1LW%'"), src, "Alike", props)
    pieces = jdbc.key_ranges(spark, src, "Alike", "VIN", props, 5)
    counts = jdbc.piece_counts(spark, src, "Alike", pieces, props)
    assert len(pieces) == 5 and sum(counts) == 702 and max(counts) < 300  # the shared prefix is left out
    read = spark.read.jdbc(src, '"Alike"', predicates=pieces, properties=props)
    assert read.rdd.getNumPartitions() == 5 and read.count() == 702
    both = ((src, props), (dst, props))
    assert jdbc.copy_table_by_key(spark, *both, "Cars", "VIN", 5) == (705, 705)
    assert jdbc.copy_table_by_key(spark, *both, "Cars", "VIN", 5) == (705, 0)
    (dst2, _) = _derby(spark, "dst2")
    jdbc.append_jdbc(spark.createDataFrame(rows[:300] + rows[701:703], "VIN string, n int"), dst2, "Cars", props)  # a copy that stopped
    assert jdbc.copy_table_by_key(spark, (src, props), (dst2, props), "Cars", "VIN", 5) == (705, 403)
    got = spark.read.jdbc(dst2, '"Cars"', properties=props)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    jdbc.append_jdbc(df.limit(0), src, "Nothing", props)
    assert jdbc.key_ranges(spark, src, "Nothing", "VIN", props, 5) == ["1 = 1"]
