"""Cutting lineage through tables in the shared checkpoint folder."""
from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table below the folder that spark.checkpoint.dir
    names and go on from there. The copy outlives the loss of executors, and its
    file size gives the planner a true estimate (a checkpoint keeps the estimate
    of the plan before it, which multiplies from join to join in a loop)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/llm-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Keep Arrow batches of whole texts small: the default of 10,000 rows of long
    documents costs each task several buffers of tens of megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark
