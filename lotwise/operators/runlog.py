"""Pipeline run log: audit rows, completion markers and the status roll-up."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import duration_seconds, duration_text

RUN_LOG_DDL = "run_id bigint, task_id string, status string, start_time timestamp, end_time timestamp, error string"


def run_status_rollup(log: DataFrame) -> DataFrame:
    """Per run: task counts, overall status (failed if any task failed,
    success if all succeeded, else running) and wall time from the first
    start to the last end. A plain grouped aggregate (partial + final)."""
    st = F.col("status")
    return log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.sum(F.when(st == "failed", 1).otherwise(0)).cast("bigint").alias("n_failed"),
        F.sum(F.when(st == "running", 1).otherwise(0)).cast("bigint").alias("n_running"),
        F.when(F.bool_or(st == "failed"), "failed").when(F.bool_and(st == "success"), "success")
         .otherwise("running").alias("overall_status"),
        duration_seconds(F.min("start_time"), F.max("end_time")).alias("duration_s"))


def task_durations(log: DataFrame) -> DataFrame:
    """Per task row: duration in seconds and as '12.34s' text."""
    return log.withColumns({"duration_s": duration_seconds("start_time", "end_time"),
                            "duration": duration_text("start_time", "end_time")})


def events_run_log(events: DataFrame) -> DataFrame:
    """Bridge: one event = one task attempt of run ``user_id``; 'error' events
    failed, 'view' events are still running, the rest succeeded after
    ``value`` seconds."""
    et = F.col("event_type")
    ts = F.col("ts").cast("timestamp")  # parquet may carry TIMESTAMP_NTZ; the session zone is UTC
    end = F.timestamp_micros(F.unix_micros(ts) + F.floor(F.col("value") * 1000000.0).cast("bigint"))
    return events.select(
        F.col("user_id").alias("run_id"),
        F.concat(et, F.lit("#"), F.col("event_id").cast("string")).alias("task_id"),
        F.when(et == "error", "failed").when(et == "view", "running").otherwise("success").alias("status"),
        ts.alias("start_time"),
        F.when(et == "view", F.lit(None).cast("timestamp")).otherwise(end).alias("end_time"),
        F.lit(None).cast("string").alias("error"))
