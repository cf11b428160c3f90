"""Exact quantiles without a whole column in one task.

Equal values are counted first (map-side combine), the distinct values are
range-partitioned, and running counts within a partition are shifted by the
totals of the partitions before it, so the values at the wanted ranks are
picked where they lie.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _c(n: str) -> Column:
    return F.col(f"`{n}`")


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], group: str | None = None) -> DataFrame:
    """(grp, column, q, value): linear-interpolated quantiles of every column over
    its non-NULL values, per value of ``group`` (NULL is a group; without
    ``group`` grp is NULL). A column or group without values has no rows."""
    grp = _c(group) if group else F.lit(None).cast("string")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("double").alias("v")) for c in cols]))
    counts = df.select(grp.alias("grp"), pairs.alias("p")).select("grp", "p.column", "p.v").where("v IS NOT NULL") \
        .groupBy("grp", "column", "v").agg(F.count("*").alias("n"))
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tagged = cut_lineage(counts.repartitionByRange(parts, "grp", "column", "v").withColumn("pid", F.spark_partition_id()))
    key = ["grp", "column"]
    sums = tagged.groupBy(*key, "pid").agg(F.sum("n").alias("here"))
    by_key = Window.partitionBy(*key)
    offsets = sums.withColumn("before", F.coalesce(F.sum("here").over(by_key.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("total", F.sum("here").over(by_key)).drop("here") \
        .select(F.col("grp").alias("g2"), F.col("column").alias("c2"), F.col("pid").alias("p2"), "before", "total")
    local = tagged.withColumn("upto", F.sum("n").over(Window.partitionBy("pid", *key).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    placed = local.join(offsets, local.grp.eqNullSafe(offsets.g2) & (local["column"] == offsets.c2) & (local.pid == offsets.p2))
    last = F.col("before") + F.col("upto") - 1
    first = last - F.col("n") + 1
    rank = F.col("q") * (F.col("total") - 1)
    hit = placed.select(*key, "v", first.alias("first"), last.alias("last"), "total", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    low = (F.floor(rank) >= F.col("first")) & (F.floor(rank) <= F.col("last"))
    high = (F.ceil(rank) >= F.col("first")) & (F.ceil(rank) <= F.col("last"))
    return hit.where(low | high).groupBy(*key, "q").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.first("total").alias("total")) \
        .select(*key, "q", (F.col("lo") + (F.col("hi") - F.col("lo")) * (rank - F.floor(rank))).alias("value"))


def quantile_columns(quantiles: DataFrame, names: dict[tuple[str, float], str], group: str | None = None) -> DataFrame:
    """One row per group (one row in all without ``group``) with a column for each
    (column, q) of ``names``; NULL where there were no values."""
    aggs = [F.max(F.when((F.col("column") == c) & (F.col("q") == float(q)), F.col("value"))).alias(out) for (c, q), out in names.items()]
    return quantiles.groupBy(F.col("grp").alias(group)).agg(*aggs) if group else quantiles.agg(*aggs)
