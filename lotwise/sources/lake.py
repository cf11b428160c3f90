"""Lake layout: metadata stamp, date/page partitioned append, manifest,
fallback target and archive snapshot."""
from __future__ import annotations

import getpass
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stamp_lake_metadata(df: DataFrame, data_source: str = "crawler", data_version: str = "1.0",
                        pipeline: str = "lake_loader", storage_system: str = "hdfs",
                        user: str | None = None) -> DataFrame:
    """Add the six-field ``datalake_metadata`` struct."""
    return df.withColumn("datalake_metadata", F.struct(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("load_timestamp"),
        F.lit(data_source).alias("data_source"), F.lit(data_version).alias("data_version"),
        F.lit(pipeline).alias("processing_pipeline"), F.lit(storage_system).alias("storage_system"),
        F.lit(user or getpass.getuser()).alias("loader_user")))


def write_lake(df: DataFrame, base: str, fmt: str = "json") -> None:
    """Append under ``<base>/load_date=<yyyy-MM-dd>/page=<n>/``. Spark names
    files uniquely per job, so repeated loads never overwrite each other. Rows
    are rebalanced by folder first: a folder gets few files, a big one is split."""
    (df.withColumn("load_date", F.date_format(F.current_date(), "yyyy-MM-dd")).hint("rebalance", "load_date", "page")
       .write.mode("append").partitionBy("load_date", "page").format(fmt).save(base))


def load_json_lines(spark: SparkSession, source: str, base: str, schema: str, fmt: str = "json") -> DataFrame:
    """Load JSON records (one a line) into the lake and go on past those that do
    not parse: the good ones are written, and so are listed in the manifest;
    returns the others as (file_path, record) for the log."""
    text = spark.read.text(source).select(F.col("value").alias("record"), F.col("_metadata.file_path").alias("file_path")).where("trim(record) != ''")
    parsed = text.withColumn("r", F.from_json("record", f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    bad = F.col("r").isNull() | F.col("r._broken").isNotNull()
    write_lake(parsed.where(~bad).select("r.*").drop("_broken"), base, fmt)
    return parsed.where(bad).select("file_path", "record")


def read_lake(spark: SparkSession, base: str, schema=None, fmt: str = "json") -> DataFrame:
    """Read the lake; ``load_date``/``page`` are partition columns, so a filter
    on them prunes folders instead of guessing paths. Manifests are skipped."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(base).withColumn("__file", F.col("_metadata.file_name"))
    return df.filter(F.col("__file") != "manifest.json").drop("__file")


def manifest_files(spark: SparkSession, base: str, load_date: str, fmt: str = "json") -> DataFrame:
    """One row per data file of one load date (only its folder is read): (load_date, page, file_path, rows)."""
    df = spark.read.format(fmt).load(base).where(F.col("load_date").cast("string") == load_date)
    return (df.groupBy("load_date", "page", F.col("_metadata.file_path").alias("file_path"))
              .agg(F.count(F.lit(1)).alias("rows")))


def load_manifest(spark: SparkSession, base: str, source_directory: str, load_date: str, user: str | None = None,
                  fmt: str = "json") -> DataFrame:
    """The manifest of one load, one row per file: load date, page, file, rows,
    the number of files of its page, source, target, user. The list is rows, not
    an array, so it may be as long as the load."""
    files = manifest_files(spark, base, load_date, fmt)
    per_page = files.groupBy(F.col("page").alias("__page")).agg(F.count(F.lit(1)).cast("int").alias("loaded_files_count"))
    return files.join(per_page, F.col("page").eqNullSafe(F.col("__page"))).select(
        F.col("load_date").alias("load_timestamp"), "page", "file_path", "rows", "loaded_files_count",
        F.lit(source_directory).alias("source_directory"), F.lit(base).alias("hdfs_directory"),
        F.lit(user or getpass.getuser()).alias("user"))


def storage_failure(e: Exception) -> bool:
    """Whether an error comes from input or output of files (also a file system that does not
    answer), not from a missing input file, the plan or the data."""
    if isinstance(e, OSError):
        return not isinstance(e, FileNotFoundError)
    cause = getattr(e, "java_exception", None) or getattr(e, "_origin", None)
    while cause is not None:
        names = [c.getName() for c in _classes(cause)]
        if any(n in ("java.io.FileNotFoundException", "org.apache.spark.SparkFileNotFoundException") for n in names):
            return False
        if "java.io.IOException" in names or "java.io.UncheckedIOException" in names:
            return True
        cause = cause.getCause()
    return False


def _classes(obj) -> list:
    out, c = [], obj.getClass()
    while c is not None:
        out.append(c)
        c = c.getSuperclass()
    return out


def write_with_fallback(df: DataFrame, primary: str, fallback: str,
                        writer: Callable[[DataFrame, str], None] = write_lake) -> DataFrame:
    """Write to ``primary``; if its storage fails, write to ``fallback`` with
    ``storage_system='local_fallback'`` and return the whole reason. Returns one
    status row (target, storage_type, reason). A failure of the input itself (its plan, its
    files, its expressions) is raised. Spark's writers publish files when
    the job commits, so a write that failed before that leaves none behind."""
    spark = df.sparkSession
    try:
        writer(df, primary)
        return spark.createDataFrame([(primary, "primary", None)], "target string, storage_type string, reason string")
    except Exception as e:  # noqa: BLE001 - sorted by cause
        if not storage_failure(e):
            raise
        reason = f"{type(e).__name__}: {e}"
        if "datalake_metadata" in df.columns:
            df = df.withColumn("datalake_metadata", F.col("datalake_metadata").withField(
                "storage_system", F.lit("local_fallback")))
        writer(df, fallback)
        return spark.createDataFrame([(fallback, "local_fallback", reason)],
                                     "target string, storage_type string, reason string")


def archive_snapshot(df: DataFrame, archive_root: str, fmt: str = "json") -> str:
    """Timestamped full copy of processed input: ``<root>/json_data_<yyyyMMddHHmmss>_<unique>``."""
    ts = df.sparkSession.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMddHHmmss")).first()[0]
    target = f"{archive_root.rstrip('/')}/json_data_{ts}_{uuid4().hex[:8]}"
    df.write.mode("errorifexists").format(fmt).save(target)
    return target
