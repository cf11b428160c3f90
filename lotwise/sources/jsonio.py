"""Listing JSON readers (flat ETL form and the nested converter form)."""
from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LISTING_FIELDS, LISTING_JSON_SCHEMA


def read_listing_json(spark: SparkSession, path: str, schema=LISTING_JSON_SCHEMA,
                      multiline: bool = True) -> DataFrame:
    """Explicit schema (no inference pass), PERMISSIVE, recursive, ``*.json``
    only and never a manifest. A JSON object or array in a string field is
    kept as its JSON text."""
    df = (spark.read.schema(schema).option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
          .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path))
    return df.filter(F.col("_metadata.file_name") != "manifest.json")


def flatten_nested_listing(df: DataFrame) -> DataFrame:
    """Nested converter output -> the flat 17-field listing (features joined '; ')."""
    ov = F.col("overview")
    get = (lambda k: ov[k]) if "overview" in df.columns else (lambda k: F.lit(None).cast("string"))
    cols = {
        "Title": F.col("title"), "Cash Price": F.col("price_info.cash_price"),
        "Finance Price": F.col("price_info.finance_price"), "Finance Details": F.col("price_info.finance_details"),
        "Features": F.array_join(F.col("features"), "; "),
    }
    return df.select(*[cols.get(k, get(k)).alias(k) for k in LISTING_FIELDS])


def first_nonempty_source(spark: SparkSession, candidates: Iterable[str],
                          reader: Callable[[SparkSession, str], DataFrame] = read_listing_json) -> str | None:
    """First candidate path that exists and holds at least one row. The test
    is ``limit(1)`` (one task reads until the first row), not a full count."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in candidates:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            continue
        if reader(spark, p).limit(1).count() > 0:
            return p
    return None
