import os
import uuid

import pytest
from pyspark.sql import functions as F

from lotwise.operators import storage as ST
from lotwise.operators import trigrams as TG
from lotwise.operators.cleaning import require_columns
from lotwise.operators.dedup import dedup_by_key, dedup_report, pack_texts, packed_row, unpack_texts
from lotwise.operators.search import SearchCriteria, ilike_contains, search_listings, search_serving
from lotwise.operators.transform import transform_listings
from lotwise.operators.warehouse import incremental_load, listing_wide, read_warehouse, vertical_split
from lotwise.schemas import TRANSFORMED_COLUMNS
from lotwise.session import scratch_path

from .conftest import raw_rows

ROWS = [
    {"Title": "2018 Pine Hauler Max", "Cash Price": "$28,750", "Finance Price": "$2,417/moEstimate",
     "Finance Details": "$3,150 due at signing · 54 mo · 6.05% APR", "Mileage": "45,610 miles", "VIN": "V1",
     "Fuel Type": "Gas", "Engine": "3.5L V6 Gas", "Features": "Bluetooth; Backup Camera"},
    {"Title": "2018 Pine Hauler Max", "Cash Price": "N/A", "VIN": "V1"},                       # duplicate key
    {"Title": "2019 Honda Civic", "Cash Price": "$9,999", "Finance Details": "Not Available", "VIN": "V2",
     "Fuel Type": "Hybrid"},
    {"Title": "2018 Kia Soul", "Cash Price": "No Cash Price", "VIN": "V3", "Fuel Type": "Gas"},
    {"Title": "2017 Kia Rio", "Cash Price": "$5,000", "VIN": None},
    {"Title": "2016 Kia Rio", "Cash Price": "$5,100", "VIN": None},
    {"Title": "2015 Audi A4", "Cash Price": "$7,000", "VIN": "N/A"},
]


def test_transform_shape_and_dedup(spark):
    out = transform_listings(raw_rows(spark, ROWS))
    assert out.columns == TRANSFORMED_COLUMNS + ["Drivetrain"]
    rows = {r["VIN"]: r for r in out.collect()}
    assert len(rows) == 5  # V1, V2, V3, NULL (one group), 'N/A' (kept: VIN is not cleaned)
    v1 = rows["V1"]
    assert v1["Cash Price (USD)"] == "28,750" and v1["Installment Per Month"] == "2"
    assert (v1["Down Payment"], v1["Loan Term (Months)"], v1["Interest Rate (APR)"]) == ("3,150", "54", "6.05")
    assert v1["Mileage"] == "45,610" and v1["Year of Manufacture"] == "2018" and v1["Car Make"] == "Pine"
    assert rows["V2"]["Down Payment"] is None


def test_dedup_is_deterministic_and_reported(spark):
    df = raw_rows(spark, ROWS)
    a = sorted(map(tuple, dedup_by_key(df).collect()), key=str)
    b = sorted(map(tuple, dedup_by_key(df.repartition(3)).collect()), key=str)
    assert a == b
    rep = dedup_report(df).first()
    assert (rep["before"], rep["after"], rep["removed"]) == (7, 5, 2)


def test_split_rejoins_to_wide(spark):
    lst = transform_listings(raw_rows(spark, ROWS))
    t = vertical_split(lst)
    assert all(r["VIN"] is not None for r in t["car_info"].collect())
    wide = listing_wide(t)
    assert wide.count() == t["car_info"].count() == 4


def test_fanout_and_missing_children(spark):
    t = vertical_split(transform_listings(raw_rows(spark, ROWS)))
    t = dict(t)
    t["in_exterior"] = t["in_exterior"].unionByName(t["in_exterior"].filter("VIN = 'V1'"))
    t["evaluate"] = t["evaluate"].filter("VIN <> 'V2'")
    wide = listing_wide(t)
    assert wide.filter("VIN = 'V1'").count() == 2
    assert wide.filter("VIN = 'V2'").first()["Mileage"] is None


def test_search(spark):
    wide = listing_wide(vertical_split(transform_listings(raw_rows(spark, ROWS))))
    assert search_listings(wide, SearchCriteria(), ordered=False).count() == wide.count()
    got = [r["VIN"] for r in search_listings(wide, SearchCriteria(price_min=0, price_max=100000)).collect()]
    assert got == ["N/A", "V2", "V1"]  # numeric order; unreadable price never matches a range
    ordered = [r["VIN"] for r in search_listings(wide, SearchCriteria()).collect()]
    assert ordered[-1] == "V3"  # NULL price sorts last
    assert search_listings(wide, SearchCriteria(car_make="pi%", raw_like=True), ordered=False).count() == 1
    assert search_listings(wide, SearchCriteria(car_make="pi%"), ordered=False).count() == 0


def test_incremental_load_is_idempotent(spark):
    root = scratch_path(spark, f"test-wh-{uuid.uuid4().hex}")
    lst = transform_listings(raw_rows(spark, ROWS))
    first = dict(incremental_load(spark, lst, root, run_id=1, user="t").collect())
    second = dict(incremental_load(spark, lst, root, run_id=2, user="t").collect())
    assert first["car_info"] == 4 and all(v == 0 for v in second.values())
    wh = read_warehouse(spark, root)
    assert wh["car_info"].count() == 4
    assert spark.read.parquet(f"{root}/etl_log").count() == 2


def test_plans_have_no_python_udf_and_use_anti_join(spark):
    from lotwise.operators.warehouse import anti_join_existing
    lst = transform_listings(raw_rows(spark, ROWS))
    plan = anti_join_existing(lst, lst.limit(1))._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
    wide = listing_wide(vertical_split(lst))
    s = search_listings(wide, SearchCriteria(fuel_type="gas"))
    assert "PythonUDF" not in s._jdf.queryExecution().executedPlan().toString()


def test_missing_required_columns_raise(spark):
    df = raw_rows(spark, ROWS)
    with pytest.raises(Exception, match="No Such Column"):
        require_columns(df, ["VIN", "No Such Column"]).count()


def _tables(spark, n=60):
    rows = [{"Title": f"20{10 + i % 12} {['Toyota', 'Aston Martin', 'Ford'][i % 3]} X{i}", "VIN": f"V{i}", "Fuel Type": ["Gas", "Electric", None][i % 3],
             "Cash Price": [f"${i},{i:03d}.5{i % 10}", "N/A", f"${i * 700}"][i % 3], "Mileage": f"{i} miles", "Engine": "2.5L Gas", "Features": f"Bluetooth; F{i}"} for i in range(n)]
    return vertical_split(transform_listings(raw_rows(spark, rows)))


def test_tables_of_bucketed_listings_are_written_without_a_shuffle(spark):
    """Listings stored in buckets by VIN deliver these buckets, one file each; NULL keys and odd texts come back."""
    rows = [(f"V{i}", f"t \u00b7 {i}" if i % 3 else None) for i in range(50)] + [(None, "no key"), ("V1", "twice")]
    df = spark.createDataFrame(rows, "`VIN` string, `Cash Price (USD)` string")
    path = scratch_path(spark, "bucketed-" + uuid.uuid4().hex)
    ST.write_bucketed(spark, df.repartition(7), path, 4)
    back = ST.read_bucketed(spark, df.schema, path, 4)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) == sorted(map(str, spark.read.schema(df.schema).parquet(path).collect()))
    assert len(spark.read.parquet(path).inputFiles()) == 4
    with ST._buckets_kept(spark):
        again = back.where("VIN IS NOT NULL").select("VIN").repartition(4, "VIN").sortWithinPartitions("VIN")
        assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and again.rdd.getNumPartitions() == 4
    copy = scratch_path(spark, "bucketed-" + uuid.uuid4().hex)
    ST.write_bucketed(spark, back.where("VIN IS NOT NULL"), copy, 4)
    assert len(spark.read.parquet(copy).inputFiles()) <= 4 and spark.read.parquet(copy).count() == 51
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"


def test_serving_copy_joins_without_shuffle_and_pushes_filters(spark):
    root = scratch_path(spark, "serving-" + uuid.uuid4().hex)
    ST.write_serving(spark, _tables(spark), root, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = search_serving(ST.read_serving(spark, root), SearchCriteria(year=2012, car_make="TO", price_min=0, price_max=90000, fuel_type="gas"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        full = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 5 and plan.count("Exchange") == 1 and "Exchange rangepartitioning" in plan  # the final order only
    for pushed in ("GreaterThanOrEqual(Price_Cents,0)", "LessThanOrEqual(Price_Cents,9000000)", "StringContains(Make_Lower,to)",
                   "StringContains(Fuel_Lower,gas)", "EqualTo(Year_Of_Manufacture,2012)"):
        assert pushed in full, pushed


def test_serving_search_equals_the_plain_search_and_copies_swap_whole(spark):
    root = scratch_path(spark, "serving-" + uuid.uuid4().hex)
    t = _tables(spark)
    ST.write_serving(spark, t, root, buckets=3)
    wide = listing_wide(t)
    for cr in (SearchCriteria(), SearchCriteria(price_min=14014.54), SearchCriteria(price_max=14014.541), SearchCriteria(price_min=14014.545, price_max=1e30),
               SearchCriteria(car_make="o_a", raw_like=True), SearchCriteria(car_make="%"), SearchCriteria(car_make="ASTON m", fuel_type="ELEC", installment_support=False),
               SearchCriteria(fuel_type="gas", engine="2.5l", features=["Bluetooth", "F1"], features_all=True)):
        got = search_serving(ST.read_serving(spark, root), cr).collect()
        assert got == search_listings(wide, cr).collect(), cr
    before = ST.read_serving(spark, root)
    ST.write_serving(spark, {n: df.where("VIN < 'V2'") for n, df in t.items()}, root, buckets=5)
    assert before["car_info"].count() == 60  # an open reader keeps its copy
    assert {n: df.count() for n, df in ST.read_serving(spark, root).items()} == {n: 12 for n in t}


def test_trigram_index_reads_few_files_and_finds_the_same_rows(spark):
    rows = [(f"{1990 + i % 30} {m} Model {i}", f"Sunroof; Code{i}" if i % 4 else None) for i, m in enumerate(["Ärö", "BMW", "Cadillac", "Dodge", "Éxo", "Fiat"] * 200)]
    rows += [(None, "x"), ("", ""), ("ab", "a_b%c")]
    df = spark.createDataFrame([(i, t[5:] if t else t, f) for i, (t, f) in enumerate(rows)], "id int, title string, features string")
    root = scratch_path(spark, "grams-" + uuid.uuid4().hex)
    TG.write_indexed(df, root, ["title", "features"], "title", 24)
    read = {}
    for column, value, raw in [("title", "CADILLAC", False), ("title", "ärö", False), ("title", "Model 11", False), ("features", "code1001", False), ("features", "nothing like it", False),
                               ("title", "bm", False), ("title", "", False), ("features", "_b%C", False), ("features", "sun%code77", True), ("title", "d_dge", True),
                               ("features", "a\\_b", True), ("id", "100", False)]:
        test = ilike_contains(F.col(column).cast("string"), value, raw)
        want = sorted(r.id for r in df.where(test).collect())
        if column != "id":
            assert sorted(r.id for r in TG.search_indexed(spark, root, column, value, raw).collect()) == want, value
        files, total = TG.candidate_files(spark, root, column, value, raw)
        read[value] = len(files) / total
    assert read["bm"] == read[""] == read["a\\_b"] == read["100"] == 1 and read["nothing like it"] == 0
    assert read["CADILLAC"] < 0.4 and read["code1001"] < 0.3 and read["CADILLAC"] < read["bm"]
    TG.write_indexed(df.limit(0), root, ["title"], "title", 2)
    assert TG.search_indexed(spark, root, "title", "bmw").count() == 0


def test_packed_texts_keep_values_and_order(spark):
    values = [None, "", "\x00", "\x01", "\x02", "\x03", "a", "a\x00", "a\x00\x01", "\x01\x00", "\x00\x01\x02", "é", "\U0010ffff", "ab"]
    rows = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", pack_texts([F.col("a"), F.col("b")]).alias("p"))
    got = df.orderBy("p").select("a", "b", unpack_texts(F.col("p"), 2).alias("back")).collect()
    assert all([r.a, r.b] == r.back for r in got)
    assert [(r.a, r.b) for r in got] == sorted(rows, key=lambda r: [(x is None, (x or "").encode()) for x in r])
    odd = spark.range(1).select(pack_texts([F.expr("cast(X'ff41' AS string)"), F.lit("b")]).alias("p"))
    assert odd.select(F.hex(unpack_texts(F.col("p"), 2)[0].cast("binary"))).first()[0] == "FF41"


def test_dedup_shuffles_packed_rows(spark):
    df = spark.range(4000).select((F.col("id") % 3000).cast("string").alias("VIN"), *[F.when(F.col("id") % (i + 2) > 0, F.concat(F.lit("v"), "id")).alias(f"c{i}") for i in range(16)])
    rows = {}
    for r in df.collect():
        key = [(x is None, x or "") for x in r[1:]]
        if r.VIN not in rows or key < rows[r.VIN][0]:
            rows[r.VIN] = (key, tuple(r))
    out = dedup_by_key(df)
    assert {tuple(r) for r in out.collect()} == {v[1] for v in rows.values()} and out.count() == 3000
    row = next(f.dataType for f in df.groupBy("VIN").agg(F.min(packed_row(df, "VIN")[0]).alias("r")).schema if f.name == "r")
    assert row.fieldNames() == ["t0"]  # one text, no slot a column


def test_load_moves_keys_only_and_leaves_no_copies(spark):
    root = scratch_path(spark, f"load-{uuid.uuid4().hex}")
    lst = transform_listings(raw_rows(spark, ROWS))
    folder = os.path.dirname(root)

    def kept():
        return {n for n in os.listdir(folder.removeprefix("file:")) if n.startswith("cut-")} if os.path.isdir(folder.removeprefix("file:")) else set()

    checkpoints = lambda: sum(len(d) for _, d, _ in os.walk(os.path.dirname(folder).removeprefix("file:")) if any(x.startswith("rdd-") for x in d))
    before, rdds = kept(), checkpoints()
    first = {r["table"]: r.rows_added for r in incremental_load(spark, lst, root, run_id=1).collect()}
    second = {r["table"]: r.rows_added for r in incremental_load(spark, lst, root, run_id=2).collect()}
    more = lst.unionByName(lst.where("VIN = 'V1'").withColumn("VIN", F.lit("V9")))
    third = {r["table"]: r.rows_added for r in incremental_load(spark, more, root, run_id=3).collect()}
    assert set(first.values()) == {4} and set(second.values()) == {0} and set(third.values()) == {1}
    assert read_warehouse(spark, root)["car_info"].count() == 5
    assert kept() == before and checkpoints() == rdds


def test_read_csv_reads_the_typed_cleaned_listings():
    from lotwise.plans.catalog import ORACLE
    assert ORACLE["read_csv"] == ORACLE["write_csv"] != ORACLE["read_raw_csv"]


def test_every_vector_asks_for_its_neighbours(spark, tmp_path):
    from lotwise.plans.catalog import ORACLE, QUERIES
    rows = [(i, [float(i % 7), float(i // 7)], 0) for i in range(1, 41)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["knn_join"](spark, str(tmp_path)).collect()
    assert sorted({r.qid for r in got}) == list(range(1, 41)) and len(got) == 40 * 20
    assert "% 100" not in ORACLE["knn_join"]


def test_every_listing_asks_for_its_neighbours(spark, monkeypatch):
    from lotwise.plans import queries_model
    from lotwise.plans.catalog import ORACLE, QUERIES
    rows = [(f"1LW{i:014d}", [float(i % 5), 0.5], [i % 3, i % 2]) for i in range(1, 31)]
    monkeypatch.setattr(queries_model, "_encoded", lambda s, d: s.createDataFrame(rows, "VIN string, z array<double>, codes array<int>"))
    got = QUERIES["knn_listings"](spark, "").collect()
    assert {r.qid for r in got} == {r[0] for r in rows} and len(got) == 30 * 20
    assert "% 100" not in ORACLE["knn_listings"]


def test_warehouse_and_index_files_use_the_codec_of_stored_copies(spark, tmp_path):
    from lotwise.operators.trigrams import search_indexed, write_indexed
    from lotwise.operators.warehouse import _write_part
    rows = spark.createDataFrame([(f"V{i}", f"2018 Mazda {i}") for i in range(50)], "VIN string, title string")
    write_indexed(rows, f"{tmp_path}/indexed", ["title"], "title", 2)
    assert _write_part(rows, f"{tmp_path}/part") == 50
    files = [f for f in tmp_path.rglob("*.parquet") if not f.name.startswith(".")]
    assert len(files) >= 3 and all(f.name.endswith(".zstd.parquet") for f in files)
    assert search_indexed(spark, f"{tmp_path}/indexed", "title", "mazda 4").count() == 11
