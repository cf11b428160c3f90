"""Keys for sources and sinks and the incremental load (2.12).

Each writes what Spark derives from the driver tables into a fresh folder
below the shared checkpoint directory, reads it back and returns the result,
so the check covers the real write + read path.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.warehouse import incremental_load, read_table, run_audit_row
from ..schemas import LISTING_FIELDS, OVERVIEW_FIELDS, WAREHOUSE_TABLES
from ..session import scratch_path
from ..sources import files, jdbc, jsonio, kvtext, lake, web
from . import oracle as O
from .catalog import clean, listing, raw, register
from .oracle import q, with_ctes
from .views import raw_listing


def _scratch(spark: SparkSession, key: str) -> str:
    return scratch_path(spark, f"{key}-{uuid.uuid4().hex[:12]}")


def _written_records(s: SparkSession, d: str, key: str) -> str:
    """raw listing -> 'Key: value' record text, bulk layout (RS-separated)."""
    r = raw(s, d)
    out = _scratch(s, key)
    r.select(kvtext.render_kv(r).alias("value")).write.option("lineSep", kvtext.RECORD_SEP).text(out)
    return out


# ---------------------------------------------------------------------------
# key/value text
# ---------------------------------------------------------------------------
@register("read_kv_text", with_ctes(["raw_listing"], "SELECT " + ", ".join(
    f"{O.py_strip(q(c))} AS {q(c)}" for c in LISTING_FIELDS) + " FROM raw_listing"))
def _read_kv_text(s, d):
    path = _written_records(s, d, "kv")
    recs = kvtext.read_kv_text(s, path, record_sep=kvtext.RECORD_SEP)
    return kvtext.kv_to_fields(recs).select(*LISTING_FIELDS)


_FEATS = "list_filter(list_transform(string_split({0}, ';'), lambda x: trim(x)), lambda x: x <> '')"


@register("kv_to_nested", with_ctes(["raw_listing"], f"""
SELECT coalesce({O.py_strip('"Title"')}, 'No Title') AS title,
  coalesce({O.py_strip('"Cash Price"')}, 'N/A') AS cash_price,
  coalesce({O.py_strip('"Finance Price"')}, 'N/A') AS finance_price,
  coalesce({O.py_strip('"Finance Details"')}, 'N/A') AS finance_details,
  array_to_string(list_sort(list_filter([{', '.join(f"'{c}=' || {O.py_strip(q(c))}" for c in OVERVIEW_FIELDS)}], lambda x: x IS NOT NULL)), '|') AS overview,
  coalesce(array_to_string({_FEATS.format(O.py_strip(q('Features')))}, '|'), '') AS features
FROM raw_listing"""))
def _kv_to_nested(s, d):
    recs = kvtext.read_kv_text(s, _written_records(s, d, "nested"), record_sep=kvtext.RECORD_SEP)
    n = kvtext.kv_to_nested(recs)
    return n.select("title", "price_info.cash_price", "price_info.finance_price", "price_info.finance_details",
                    F.array_join(F.array_sort(F.transform(F.map_entries("overview"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "|").alias("overview"),
                    F.array_join("features", "|").alias("features"))


SIDECAR_TIME = "concat('2024-01-', lpad(CAST(idx AS VARCHAR), 2, '0'), ' 08:00:00')"


@register("attach_sidecar", with_ctes(["raw_listing"], f"""
SELECT r."VIN", r.page, r.idx, m.crawl_time, m.crawl_time IS NOT NULL AS has_meta
FROM raw_listing r LEFT JOIN (SELECT DISTINCT page, idx, {SIDECAR_TIME} AS crawl_time FROM raw_listing
                              WHERE idx <= 6) m ON r.page = m.page AND r.idx = m.idx"""))
def _attach_sidecar(s, d):
    """Sidecars exist for line numbers 1-6 only and belong to a record by its path."""
    root = "/crawl"
    r = raw(s, d)
    out = _scratch(s, "sidecar")
    side = (r.filter(F.col("idx") <= 6).select("page", "idx").distinct()
             .select(F.concat(F.lit("2024-01-"), F.lpad(F.col("idx").cast("string"), 2, "0"), F.lit(" 08:00:00"))
                     .alias("crawl_time"), F.col("page"), F.col("idx").alias("index")))
    side.write.json(out)
    records = r.withColumn("source_path", F.concat_ws("/", F.lit(root), "page", F.concat(F.col("idx").cast("string"), F.lit(".txt"))))
    j = kvtext.attach_sidecar(records, kvtext.read_sidecars(s, out, bulk_root=root))
    return j.select("VIN", "page", "idx", "metadata.crawl_time", F.col("metadata").isNotNull().alias("has_meta"))


_RAW_SQL = "SELECT " + ", ".join(q(c) for c in LISTING_FIELDS) + ", page, idx FROM raw_listing"
_RAW_COLUMNS = [*LISTING_FIELDS, "page", "idx"]


@register("write_json_by_page", with_ctes(["raw_listing"], _RAW_SQL))
def _write_json_by_page(s, d):
    out = _scratch(s, "bypage")
    kvtext.write_json_by_page(raw_listing(s, d, by_page=True), out, compression="gzip", dealt=True)
    back = s.read.schema(", ".join(f"`{c}` string" for c in LISTING_FIELDS) + ", idx int, page int").json(out)
    return back.select(*_RAW_COLUMNS)


@register("conversion_summary", with_ctes(["raw_listing"], "SELECT count(*) AS converted_files_count, true AS timed FROM raw_listing"))
def _conversion_summary(s, d):
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return kvtext.conversion_summary(raw(s, d)).select("converted_files_count", (F.col("conversion_time") == now).alias("timed"))


# ---------------------------------------------------------------------------
# lake
# ---------------------------------------------------------------------------
@register("stamp_lake_metadata", with_ctes(["raw_listing"], "SELECT \"VIN\", 'crawler' AS data_source, "
                                           "'1.0' AS data_version, 'lake_loader' AS processing_pipeline, "
                                           "'hdfs' AS storage_system FROM raw_listing"))
def _stamp(s, d):
    st = lake.stamp_lake_metadata(raw(s, d))
    return st.select("VIN", "datalake_metadata.data_source", "datalake_metadata.data_version",
                     "datalake_metadata.processing_pipeline", "datalake_metadata.storage_system")


@register("write_lake", with_ctes(["raw_listing"], _RAW_SQL.replace(" FROM", ", true AS dated, 'hdfs' AS storage_system FROM")))
def _write_lake(s, d):
    base = _scratch(s, "lake")
    lake.write_lake(lake.stamp_lake_metadata(raw(s, d)), base, fmt="parquet")
    back = lake.read_lake(s, base, fmt="parquet")
    return back.select(*_RAW_COLUMNS, F.col("load_date").isNotNull().alias("dated"), "datalake_metadata.storage_system")


_BROKEN = "idx % 5 = 0"


@register("load_json_lines", with_ctes(["raw_listing"], f"""SELECT CASE WHEN {_BROKEN} THEN 'rejected' ELSE 'loaded' END AS status, page, idx,
  CASE WHEN NOT ({_BROKEN}) THEN "VIN" END AS "VIN", CASE WHEN NOT ({_BROKEN}) THEN "Title" END AS "Title" FROM raw_listing"""))
def _load_json_lines(s, d):
    """JSON lines, every fifth listing of a page cut off: the good ones reach the lake, the others the log."""
    source, base = _scratch(s, "lines"), _scratch(s, "lake_lines")
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in _RAW_COLUMNS]))
    cut = F.concat(F.lit('{"page": '), F.col("page").cast("string"), F.lit(', "idx": '), F.col("idx").cast("string"), F.lit(', "Title": "half'))
    raw(s, d).select(F.when(F.expr(_BROKEN), cut).otherwise(whole).alias("value")).write.text(source)
    schema = ", ".join(f"`{c}` string" for c in LISTING_FIELDS) + ", page int, idx int"
    bad = lake.load_json_lines(s, source, base, schema, fmt="parquet")
    rejected = bad.select(F.lit("rejected").alias("status"), F.get_json_object(F.concat("record", F.lit('"}')), "$.page").cast("int").alias("page"),
                          F.get_json_object(F.concat("record", F.lit('"}')), "$.idx").cast("int").alias("idx"),
                          F.lit(None).cast("string").alias("VIN"), F.lit(None).cast("string").alias("Title"))
    return lake.read_lake(s, base, fmt="parquet").select(F.lit("loaded").alias("status"), "page", "idx", "VIN", "Title").unionByName(rejected)


@register("load_manifest", with_ctes(["raw_listing"], "SELECT page, count(*) AS rows, true AS has_files, true AS counted FROM raw_listing GROUP BY page"))
def _load_manifest(s, d):
    base = _scratch(s, "manifest")
    lake.write_lake(raw(s, d), base, fmt="parquet")
    today = s.range(1).select(F.date_format(F.current_date(), "yyyy-MM-dd")).first()[0]
    m = lake.load_manifest(s, base, source_directory="raw_listing", load_date=today, fmt="parquet")
    return m.groupBy("page").agg(F.sum("rows").alias("rows"), F.bool_and(F.col("file_path").isNotNull()).alias("has_files"),
                                 (F.max("loaded_files_count") >= F.count(F.lit(1))).alias("counted"))


@register("write_with_fallback", with_ctes(["raw_listing"], _RAW_SQL.replace(" FROM", ", 'local_fallback' AS storage_type FROM")))
def _write_with_fallback(s, d):
    root = _scratch(s, "fallback")
    primary = "unreachable-lake://namenode/listings"  # primary storage down: no file system answers
    status = lake.write_with_fallback(lake.stamp_lake_metadata(raw(s, d)), primary, f"{root}/fallback",
                                      writer=lambda df, p: lake.write_lake(df, p, fmt="parquet"))
    target = status.first()["target"]
    return s.read.parquet(target).select(*_RAW_COLUMNS, F.col("datalake_metadata.storage_system").alias("storage_type"))


@register("archive_snapshot", with_ctes(["raw_listing"], _RAW_SQL))
def _archive(s, d):
    target = lake.archive_snapshot(raw(s, d), _scratch(s, "archive"), fmt="parquet")
    return s.read.parquet(target).select(*_RAW_COLUMNS)


# ---------------------------------------------------------------------------
# JSON / CSV
# ---------------------------------------------------------------------------
@register("read_listing_json", with_ctes(["raw_listing"], "SELECT " + ", ".join(q(c) for c in LISTING_FIELDS)
                                         + " FROM raw_listing"))
def _read_listing_json(s, d):
    out = _scratch(s, "json")
    raw(s, d).select(*LISTING_FIELDS).write.json(out)
    return jsonio.read_listing_json(s, out, multiline=False).select(*LISTING_FIELDS)


@register("first_nonempty_source", with_ctes(["raw_listing"], "SELECT 'full' AS chosen, " + ", ".join(q(c) for c in LISTING_FIELDS) + " FROM raw_listing"))
def _first_nonempty(s, d):
    root = _scratch(s, "candidates")
    s.createDataFrame([], "Title string").write.json(f"{root}/empty")
    raw(s, d).select(*LISTING_FIELDS).write.json(f"{root}/full")
    chosen = jsonio.first_nonempty_source(s, [f"{root}/missing", f"{root}/empty", f"{root}/full"],
                                          lambda sp, p: jsonio.read_listing_json(sp, p, multiline=False))
    return jsonio.read_listing_json(s, chosen, multiline=False).select(F.lit(chosen.rsplit("/", 1)[1]).alias("chosen"), *LISTING_FIELDS)


CLEAN_FIELDS = [
    ("Year of Manufacture", "double"), ("Car Make", "string"), ("Car Full Title", "string"),
    ("Cash Price (USD)", "double"), ("VIN", "string"), ("Mileage", "double"), ("Fuel Type", "string"),
    ("MPG", "string"), ("Exterior", "string"), ("Interior", "string"), ("Transmission", "string"),
    ("Engine", "string"), ("Location", "string"), ("Listed Since", "string"), ("Stock Number", "string"),
    ("Features", "string"), ("Drivetrain", "string"), ("Financing Support", "string"), ("City MPG", "double"),
    ("Highway MPG", "double"), ("Price Category", "string")]
CLEAN_SCHEMA = ", ".join(f"`{n}` {t}" for n, t in CLEAN_FIELDS)


_CSV_SQL = with_ctes(["clean_listing"], "SELECT " + ", ".join(
    f"nullif({q(n)}, '') AS {q(n)}" if t == "string" else q(n) for n, t in CLEAN_FIELDS) + " FROM clean_listing")


@register("write_csv", _CSV_SQL)
def _write_csv(s, d):
    """CSV round trip: an empty string comes back as NULL (as any CSV reader sees it)."""
    out = _scratch(s, "csv")
    files.write_csv(clean(s, d).select(*[F.col(f"`{n}`") for n, _ in CLEAN_FIELDS]), out)
    return files.read_csv(s, out, CLEAN_SCHEMA)


@register("read_csv", _CSV_SQL)
def _read_csv(s, d):
    """Cleaned listings as a CSV writer leaves them, read back with their typed schema."""
    return _write_csv(s, d)


@register("read_raw_csv", with_ctes(["raw_listing"], "SELECT " + ", ".join(f"nullif({q(c)}, '') AS {q(c)}" for c in LISTING_FIELDS) + ", page FROM raw_listing"))
def _read_raw_csv(s, d):
    """Raw listings as any CSV writer leaves them, read back with a schema."""
    out = _scratch(s, "csv_raw")
    raw(s, d).select(*LISTING_FIELDS, "page").write.option("header", "true").option("escape", '"').option("ignoreTrailingWhiteSpace", "false").option("ignoreLeadingWhiteSpace", "false").csv(out)
    return files.read_csv(s, out, ", ".join(f"`{c}` string" for c in LISTING_FIELDS) + ", page int")


# ---------------------------------------------------------------------------
# JDBC (embedded Derby in a scratch folder: no server, no port)
# ---------------------------------------------------------------------------
def _derby(s: SparkSession, key: str) -> tuple[str, dict]:
    return (f"jdbc:derby:{_scratch(s, key)}/db;create=true",
            {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})


def _car_info(s, d) -> DataFrame:
    return read_warehouse_from_listing(s, d)["car_info"]


def read_warehouse_from_listing(s, d):
    from ..operators.warehouse import vertical_split
    return vertical_split(listing(s, d))


@register("append_jdbc", with_ctes(["car_info"], "SELECT * FROM car_info"))
def _append_jdbc(s, d):
    url, props = _derby(s, "jdbc_append")
    jdbc.append_jdbc(_car_info(s, d), url, "Car_Info", props)
    return s.read.jdbc(url, '"Car_Info"', properties=props)


@register("read_jdbc_subquery", with_ctes(["car_info"], 'SELECT "VIN" FROM car_info'))
def _read_jdbc_subquery(s, d):
    url, props = _derby(s, "jdbc_read")
    jdbc.append_jdbc(_car_info(s, d), url, "Car_Info", props)
    missing = jdbc.read_jdbc_subquery(s, url, 'SELECT "VIN" FROM "No_Such_Table"', props, "VIN string")
    parts = jdbc.key_ranges(s, url, "Car_Info", "VIN", props, int(s.conf.get("spark.sql.shuffle.partitions")))  # one task each
    keys = jdbc.read_jdbc_subquery(s, url, 'SELECT "VIN" FROM "Car_Info"', props, "VIN string", parts)
    return keys.unionByName(missing)


@register("resolve_table_alias", with_ctes(["other_detail"], "SELECT *, 'Other_Details' AS resolved FROM other_detail"))
def _resolve_alias(s, d):
    read_warehouse_from_listing(s, d)["other_detail"].createOrReplaceTempView("Other_Details")
    try:
        name = jdbc.resolve_table_alias(s, ["Other_Detail", "Other_Details"])
        return s.table(name).withColumn("resolved", F.lit(name))
    finally:  # the plan is resolved; no later key sees the view
        s.catalog.dropTempView("Other_Details")


_COPIED = ["car_info", "installment_info", "in_exterior", "evaluate", "engine_info", "other_detail"]


@register("copy_tables", with_ctes(_COPIED, " UNION ALL ".join(
    f"SELECT '{jdbc.TABLE_NAMES[t]}' AS \"table\", count(*) AS rows, 'ok' AS status FROM {t}" for t in _COPIED)
    + " UNION ALL SELECT 'Missing_Table', NULL, 'error: AnalysisException'"))
def _copy_tables(s, d):
    src_url, props = _derby(s, "copy_src")
    dst_url, _ = _derby(s, "copy_dst")
    t = read_warehouse_from_listing(s, d)
    for name in _COPIED:
        jdbc.append_jdbc(t[name], src_url, jdbc.TABLE_NAMES[name], props)
    rep = jdbc.copy_tables(s, [jdbc.TABLE_NAMES[name] for name in _COPIED] + ["Missing_Table"], jdbc.jdbc_reader(s, src_url, props), jdbc.jdbc_writer(dst_url, props))
    return rep.withColumn("status", F.when(F.col("status").startswith("error"),
                                           F.lit("error: AnalysisException")).otherwise(F.col("status")))


@register("copy_tables_by_key", with_ctes(_COPIED, " UNION ALL ".join(
    f"SELECT '{jdbc.TABLE_NAMES[t]}' AS \"table\", \"VIN\", concat_ws('|', {', '.join(f'CAST({q(c)} AS VARCHAR)' for c, _ in WAREHOUSE_TABLES[t])}) AS content FROM {t}" for t in _COPIED)))
def _copy_tables_by_key(s, d):
    """All rows of all tables after a copy that stopped half-way (a third of each table is there) was run again."""
    (src_url, props), (dst_url, _) = _derby(s, "copy_src"), _derby(s, "copy_dst")
    t, out = read_warehouse_from_listing(s, d), None
    for name in _COPIED:
        table = jdbc.TABLE_NAMES[name]
        jdbc.append_jdbc(t[name], src_url, table, props)
        jdbc.append_jdbc(t[name].where(F.pmod(F.crc32("VIN"), F.lit(3)) == 0), dst_url, table, props)
        for _ in range(2):  # the second run finds nothing to do
            jdbc.copy_table_by_key(s, (src_url, props), (dst_url, props), table, "VIN", int(s.conf.get("spark.sql.shuffle.partitions")))
        rows = s.read.jdbc(dst_url, jdbc.quote(table), predicates=jdbc.key_ranges(s, dst_url, table, "VIN", props, 4), properties=props)
        part = rows.select(F.lit(table).alias("table"), "VIN", F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c, _ in WAREHOUSE_TABLES[name]]).alias("content"))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------------------
# web pages
# ---------------------------------------------------------------------------
@register("listing_links", """
SELECT page_id, i - 1 AS pos, links[i] AS href
FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS links FROM pages) p,
     LATERAL (SELECT unnest(generate_series(1, len(links))) AS i)
WHERE i - 1 < 30""")
def _listing_links(s, d):
    return web.listing_links(s.read.parquet(f"{d}/pages.parquet"), attr=None, cap=30)


_PLANTED = ("<a href=\"/([a-m])", "<a data-test=\"cardLinkCover\" href=\"/{}1")


@register("listing_links_attr", f"""
SELECT page_id, i - 1 AS pos, regexp_extract(anchors[i], 'href="([^"]*)"', 1) AS href
FROM (SELECT page_id, list_filter(regexp_extract_all(regexp_replace(html, '{_PLANTED[0]}', '{_PLANTED[1].format(chr(92))}', 'g'), '(<a\\s[^>]*>)', 1),
             lambda a: contains(a, '{web.LINK_ATTR}')) AS anchors FROM pages) p,
     LATERAL (SELECT unnest(generate_series(1, len(anchors))) AS i)
WHERE i - 1 < 30""")
def _listing_links_attr(s, d):
    """Only anchors with the listing attribute count; here links to a-m carry it."""
    pages = s.read.parquet(f"{d}/pages.parquet").withColumn("html", F.regexp_replace("html", _PLANTED[0], _PLANTED[1].format("$")))
    return web.listing_links(pages)


def _html_text_sql(c):
    t = f"regexp_replace({c}, '<[^>]+>', '', 'g')"
    for ent, ch in web.ENTITIES:
        t = f"replace({t}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return O.py_strip(t)


def _grab(pat):
    return f"nullif(regexp_extract(html, '{pat}', 1), '')"


@register("page_title_fallback", "SELECT page_id, coalesce(" + _html_text_sql(
    "coalesce(" + _grab('(?s)<h1[^>]*' + web.TITLE_ATTR + '[^>]*>(.*?)</h1>') + ", "
    + _grab('(?s)<div[^>]*' + web.TITLE_ATTR + '[^>]*>(.*?)</div>') + ", "
    + _grab("(?s)<h1[^>]*>(.*?)</h1>") + ")") + ", 'No Title') AS title FROM pages")
def _page_title(s, d):
    return web.page_title_fallback(s.read.parquet(f"{d}/pages.parquet"))


ITEM_SQL = ("list_filter([" + ", ".join([
    "'Exterior: ' || \"Exterior\"", "'Interior: ' || \"Interior\"", '"Mileage"', "'Fuel Type: ' || \"Fuel Type\"",
    '"MPG"', '"Transmission"', '"Drivetrain"', '"Engine"', "'Listed ' || \"Listed Since\"", "'VIN: ' || \"VIN\"",
    "'Stock Number: ' || \"Stock Number\"", "\"Location\" || ' (' || CAST(idx AS VARCHAR) || ' miles away)'"])
    + "], lambda x: x IS NOT NULL)")


def _items(r: DataFrame):
    c = lambda n: F.col(f"`{n}`")
    its = [F.concat(F.lit("Exterior: "), c("Exterior")), F.concat(F.lit("Interior: "), c("Interior")), c("Mileage"),
           F.concat(F.lit("Fuel Type: "), c("Fuel Type")), c("MPG"), c("Transmission"), c("Drivetrain"), c("Engine"),
           F.concat(F.lit("Listed "), c("Listed Since")), F.concat(F.lit("VIN: "), c("VIN")),
           F.concat(F.lit("Stock Number: "), c("Stock Number")),
           F.concat(c("Location"), F.lit(" ("), c("idx").cast("string"), F.lit(" miles away)"))]
    return F.filter(F.array(*its), lambda x: x.isNotNull())


def _rule_sql(field: str) -> str:
    x = "x"
    strip = O.py_strip

    def after(p):
        return strip(f"replace({x}, '{p}', '')")
    rules = [
        (f"starts_with({x}, 'Exterior:')", "Exterior", after("Exterior:")),
        (f"starts_with({x}, 'Interior:')", "Interior", after("Interior:")),
        (f"contains({x}, 'miles') AND NOT contains({x}, 'miles away')", "Mileage", strip(x)),
        (f"starts_with({x}, 'Fuel Type:')", "Fuel Type", after("Fuel Type:")),
        (f"contains({x}, 'city /')", "MPG", strip(x)),
        (f"contains({x}, 'Transmission')", "Transmission", strip(x)),
        (f"{x} IN ('AWD', '4WD', 'FWD', 'RWD')", "Drivetrain", x),
        (f"contains({x}, 'L') AND contains({x}, 'Gas')", "Engine", strip(x)),
        (f"starts_with({x}, 'Listed')", "Listed Since", after("Listed")),
        (f"starts_with({x}, 'VIN:')", "VIN", after("VIN:")),
        (f"starts_with({x}, 'Stock Number:')", "Stock Number", after("Stock Number:")),
        (f"contains({x}, 'miles away')", "Location", strip(f"split_part({x}, '(', 1)")),
    ]
    fcase = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for c, n, _ in rules) + " END"
    vcase = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, _, v in rules) + " END"
    hits = f"list_filter(list_transform(items, lambda x: {{'f': {fcase}, 'v': {vcase}}}), lambda s: s.f = '{field}')"
    return f"CASE WHEN len({hits}) > 0 THEN {hits}[-1].v ELSE 'N/A' END AS {q(field)}"


@register("overview_classify", with_ctes(["raw_listing"], "SELECT " + ", ".join(_rule_sql(f) for f in OVERVIEW_FIELDS)
                                         + f" FROM (SELECT {ITEM_SQL} AS items FROM raw_listing)"))
def _overview_classify(s, d):
    r = raw(s, d)
    return web.overview_classify(r.select(_items(r).alias("items")))


# ---------------------------------------------------------------------------
# incremental load, audit, marker
# ---------------------------------------------------------------------------
_LOAD_TABLES = ["car_info", "engine_info", "evaluate", "in_exterior", "installment_info", "other_detail",
                "transformed_cars"]


@register("incremental_load", with_ctes(["listing"], " UNION ALL ".join(
    f"SELECT 1 AS run, '{t}' AS \"table\", count(DISTINCT \"VIN\") AS rows_added FROM listing" for t in _LOAD_TABLES)
    + " UNION ALL " + " UNION ALL ".join(f"SELECT 2, '{t}', 0" for t in _LOAD_TABLES)))
def _incremental_load(s, d):
    """Load the transformed listings twice into a fresh warehouse; the second
    run must add nothing (idempotent by key)."""
    root = _scratch(s, "warehouse")
    lst = listing(s, d)
    first = incremental_load(s, lst, root, run_id=1)
    second = incremental_load(s, lst, root, run_id=2)
    return (first.select(F.lit(1).alias("run"), "*")
            .unionByName(second.select(F.lit(2).alias("run"), "*")))


_LOG_SQL = "SELECT CAST({id} AS BIGINT) AS id, CAST(count(*) AS INTEGER) AS num_records_processed, 'SUCCESS' AS status, 'tester' AS executed_by, '{kind}' AS kind, true AS dated FROM car_info"


def _log(s, root):
    log = s.read.parquet(f"{root}/etl_log")
    return log.withColumn("dated", F.col("execution_date").isNotNull()).drop("execution_date")


@register("run_audit", with_ctes(["car_info"], _LOG_SQL.format(id=7, kind="load")))
def _run_audit(s, d):
    root = _scratch(s, "audit")
    incremental_load(s, listing(s, d), root, run_id=7, user="tester")
    return _log(s, root)


@register("run_marker", with_ctes(["car_info"], _LOG_SQL.format(id=9, kind="marker")))
def _run_marker(s, d):
    """A marker row for what a loaded warehouse holds."""
    root = _scratch(s, "marker")
    incremental_load(s, listing(s, d), f"{root}/warehouse", run_id=9, user="tester")
    n = read_table(s, f"{root}/warehouse", "car_info").count()
    run_audit_row(s, 9, n, "SUCCESS", "tester", kind="marker").write.mode("append").parquet(f"{root}/etl_log")
    return _log(s, root)
