"""Crawled key/value text records -> map -> flat or nested listing rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_strip, split_features
from ..schemas import LISTING_FIELDS, META_SIDECAR_SCHEMA, OVERVIEW_FIELDS

RECORD_SEP = "\x1e"  # bulk layout: many records per file, separated by RS


def read_kv_text(spark: SparkSession, path: str, record_sep: str | None = None) -> DataFrame:
    """Read listing records as (record map, source_path, page, idx).

    Default layout is the crawler's: ``<root>/<page>/<index>.txt``, one record
    per file (``wholetext``), ``*_meta.txt`` skipped. With ``record_sep`` many
    records share a file (the layout to use at scale: millions of tiny files
    overwhelm any file system listing). Lines: blank ones skipped, split at
    the first ':', both sides stripped; a repeated key keeps its last value
    (``mapKeyDedupPolicy=LAST_WIN``).
    """
    r = spark.read.option("recursiveFileLookup", "true")
    if record_sep is None:
        # text()'s own keyword default would override a wholetext option set earlier
        df = r.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    else:
        df = r.text(path, lineSep=record_sep)
    df = df.select("value", F.col("_metadata.file_path").alias("source_path"))
    if record_sep is None:
        df = df.filter(~F.col("source_path").endswith("_meta.txt"))
    return df.select(parse_kv(F.col("value")).alias("record"), "source_path",
                     F.regexp_extract("source_path", r"/([^/]+)/[^/]+$", 1).try_cast("int").alias("page"),
                     F.regexp_extract("source_path", r"/([^/]+)\.txt$", 1).try_cast("int").alias("idx"))


def parse_kv(text: Column) -> Column:
    """Record text -> map<string,string> (first ':' splits key and value)."""
    lines = F.filter(F.split(text, "\n"), lambda l: (py_strip(l) != "") & l.contains(":"))
    entries = F.transform(lines, lambda l: F.struct(
        py_strip(F.substring_index(l, ":", 1)).alias("key"),
        py_strip(F.substring(l, F.instr(l, ":") + 1, 1 << 30)).alias("value")))
    return F.map_from_entries(entries)


def render_kv(df: DataFrame, fields: list[str] = LISTING_FIELDS) -> Column:
    """Listing columns -> record text, one 'Key: value' line per non-NULL field."""
    return F.concat_ws("\n", *[F.when(F.col(f"`{k}`").isNotNull(), F.concat(F.lit(f"{k}: "), F.col(f"`{k}`")))
                              for k in fields if k in df.columns])


def kv_to_fields(df: DataFrame, fields: list[str] = LISTING_FIELDS, record: str = "record") -> DataFrame:
    """Map column -> the flat listing fields (absent keys are NULL)."""
    keep = [c for c in df.columns if c != record]
    return df.select(*[F.element_at(F.col(record), k).alias(k) for k in fields], *keep)


def kv_to_nested(df: DataFrame, record: str = "record") -> DataFrame:
    """Map -> nested listing: title/price_info/overview/features/crawl_time.
    Defaults: 'No Title', 'N/A' prices, empty feature list; ``overview``
    keeps only the overview keys that are present."""
    m = F.col(record)
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    ov = set(OVERVIEW_FIELDS)
    keep = [c for c in df.columns if c != record]
    return df.select(
        F.coalesce(m["Title"], F.lit("No Title")).alias("title"),
        F.struct(F.coalesce(m["Cash Price"], F.lit("N/A")).alias("cash_price"),
                 F.coalesce(m["Finance Price"], F.lit("N/A")).alias("finance_price"),
                 F.coalesce(m["Finance Details"], F.lit("N/A")).alias("finance_details")).alias("price_info"),
        F.map_filter(m, lambda k, v: k.isin(*ov)).alias("overview"),
        F.coalesce(split_features(m["Features"]), F.array().cast("array<string>")).alias("features"),
        F.coalesce(m["Crawl Time"], now).alias("crawl_time"),
        now.alias("conversion_time"), *keep)


def read_sidecars(spark: SparkSession, path: str, bulk_root: str | None = None) -> DataFrame:
    """``<index>_meta.json`` files -> (meta struct, stem of the record path). In the bulk layout many
    sidecars share a file, one a line, and belong to ``<bulk_root>/<page>/<index>``."""
    if bulk_root is not None:
        lines = spark.read.schema(META_SIDECAR_SCHEMA).option("recursiveFileLookup", "true").json(path)
        return lines.select(F.struct(*META_SIDECAR_SCHEMA.fieldNames()).alias("metadata"), F.concat_ws("/", F.lit(bulk_root), "page", "index").alias("__stem"))
    df = (spark.read.schema(META_SIDECAR_SCHEMA).option("multiLine", "true").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "*_meta.json").json(path))
    return df.select(F.struct(*META_SIDECAR_SCHEMA.fieldNames()).alias("metadata"),
                     F.regexp_replace(F.col("_metadata.file_path"), r"_meta\.json$", "").alias("__stem"))


def attach_sidecar(records: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Left join: ``metadata`` is set where a sidecar exists (one per record)."""
    r = records.withColumn("__stem", F.regexp_replace("source_path", r"\.txt$", ""))
    return r.join(sidecars, "__stem", "left").drop("__stem")


def conversion_summary(df: DataFrame) -> DataFrame:
    """(conversion_time, converted_files_count) of one conversion run."""
    return df.agg(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("conversion_time"),
                  F.count(F.lit(1)).alias("converted_files_count"))


def write_json_by_page(df: DataFrame, out: str, mode: str = "overwrite", compression: str | None = None, dealt: bool = False) -> None:
    """One output folder per page (``page=<n>``); ``compression`` names a codec that readers know by the file's ending.
    Rows are dealt by page first, unless they come ``dealt``."""
    (df if dealt else df.hint("rebalance", "page")).write.mode(mode).partitionBy("page").json(out, compression=compression)
