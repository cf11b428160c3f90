"""Session construction and lineage-cutting helpers."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. ANSI stays on (Spark 4 default); operators use
# try_* functions where the listing data is dirty.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A parsed key/value record keeps the last value of a repeated key.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # The JVM compiles no method beyond 8000 bytes of code. A wide projection whose generated loop is
    # longer would be interpreted for every row; below this limit Spark cuts it into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Settings that every query sets on the session it is given.
SESSION_KEYS = ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy", "spark.sql.codegen.hugeMethodLimit")


def get_spark(master: str | None = None, app: str = "lotwise",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's required settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k in SESSION_KEYS:
        spark.conf.set(k, conf[k])
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> str:
    """Send this package to the executors as a zip, for clusters whose workers do not have it on
    their path; returns the zip's path on the driver."""
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lotwise-ship-"), "lotwise.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("lotwise", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    context). Only a local-mode session (tests, laptop runs) gets a private
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="lotwise-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def stage(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table below the shared checkpoint folder; the frame that reads it and
    its path. A checkpoint would hold the same rows uncompressed, several times as large, and be read
    whole where a reader needs one column."""
    path = scratch_path(df.sparkSession, f"cut-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, path: str) -> None:
    """Delete a table that ``stage`` wrote, once nothing reads it any more."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (it outlives executors)."""
    return stage(df)[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for staging tables."""
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") and not base.startswith("file://") else base
    return os.path.join(base, "staging", name)
