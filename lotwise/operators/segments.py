"""Counts, crosstabs and per-segment statistics; top-k and limits.

Groupings run as hash aggregates with a map-side partial step, so a value
holding a third of all rows is pre-aggregated before the shuffle. Only
bounded frames are broadcast: the 5-row segment dimension and top-n lists.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import PRICE_SEGMENT_LABELS
from ..session import cut_lineage
from .quantiles import exact_quantiles, quantile_columns

SEG = "Price Segment"


def _c(n: str) -> Column:
    return F.col(f"`{n}`")


def segment_dim(spark: SparkSession, labels: list[str] = PRICE_SEGMENT_LABELS) -> DataFrame:
    """The ordered segment dimension (fixed five rows)."""
    return spark.createDataFrame(list(enumerate(labels)), "segment_order int, segment string")


def value_counts(df: DataFrame, col: str, name: str = "value") -> DataFrame:
    """Frequency of each non-NULL value, most frequent first (ties by value)."""
    return (df.filter(_c(col).isNotNull()).groupBy(_c(col).alias(name)).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc(name)))


def top_k_values(df: DataFrame, col: str, k: int = 5, name: str = "value") -> DataFrame:
    """The k most frequent values (count desc, value asc): a bounded top-k."""
    return value_counts(df, col, name).limit(k)


def top_n_else_other(df: DataFrame, col: str, out: str, n: int = 5, other: str = "Other") -> DataFrame:
    """Keep the n most frequent values of ``col``; everything else (NULL too)
    becomes ``other``. The n-row list is broadcast (its size is bounded by n)."""
    top = top_k_values(df, col, n, "__top").select("__top")
    j = df.join(F.broadcast(top), _c(col) == F.col("__top"), "left")
    return j.withColumn(out, F.when(F.col("__top").isNotNull(), _c(col)).otherwise(F.lit(other))).drop("__top")


def segment_counts(df: DataFrame, seg: str = SEG) -> DataFrame:
    """Rows per segment in segment order; empty segments appear with 0."""
    counts = df.filter(_c(seg).isNotNull()).groupBy(_c(seg).alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    dim = segment_dim(df.sparkSession)
    return (F.broadcast(dim).join(counts, "segment", "left")
            .select("segment_order", "segment", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
            .orderBy("segment_order"))


def crosstab_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long-form crosstab: (row_value, col_value, n); rows with a NULL side drop."""
    return (df.filter(_c(row).isNotNull() & _c(col).isNotNull())
              .groupBy(_c(row).cast("string").alias("row_value"), _c(col).cast("string").alias("col_value"))
              .agg(F.count(F.lit(1)).alias("n")))


def crosstab_pct(df: DataFrame, row: str, col: str) -> DataFrame:
    """Row-normalised crosstab x100: n / sum(n) over the row. The window runs
    on the aggregated (small) frame, partitioned by row value."""
    ct = crosstab_counts(df, row, col)
    w = Window.partitionBy("row_value")
    return ct.select("row_value", "col_value", (F.col("n") * 100.0 / F.sum("n").over(w)).alias("pct"))


def crosstab_many(df: DataFrame, tabs: list[tuple[str, str, str]]) -> DataFrame:
    """(crosstab, row_value, col_value, n, pct) of several named (name, row, column)
    crosstabs from one pass: one count over exploded triples (combined before
    the shuffle), one window over the counted frame for the row shares."""
    triple = F.explode(F.array(*[F.struct(F.lit(name).alias("crosstab"), _c(r).cast("string").alias("row_value"), _c(c).cast("string").alias("col_value"))
                                 for name, r, c in tabs]))
    counts = df.select(triple.alias("t")).select("t.*").where("row_value IS NOT NULL AND col_value IS NOT NULL") \
        .groupBy("crosstab", "row_value", "col_value").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("crosstab", "row_value")))


def _by_segment(df: DataFrame, aggs: list[Column], seg: str = SEG) -> DataFrame:
    """Aggregate per segment and attach to the full segment dimension, so
    empty segments appear (with NULL statistics), in segment order."""
    got = df.filter(_c(seg).isNotNull()).groupBy(_c(seg).alias("segment")).agg(*aggs)
    dim = segment_dim(df.sparkSession)
    return F.broadcast(dim).join(got, "segment", "left").orderBy("segment_order")


def segment_mpg(df: DataFrame, seg: str = SEG) -> DataFrame:
    return _by_segment(df, [F.avg(_c("City MPG")).alias("city_mpg"),
                            F.avg(_c("Highway MPG")).alias("highway_mpg")], seg)


def segment_listed_days(df: DataFrame, seg: str = SEG) -> DataFrame:
    return _by_segment(df, [F.avg(_c("Listed Days")).alias("listed_days")], seg)


def segment_mileage(df: DataFrame, seg: str = SEG) -> DataFrame:
    """mean, median (exact, see ``exact_quantiles``), min, max and count of the mileage per segment."""
    df, m = cut_lineage(df.select(_c(seg), _c("Mileage"))), _c("Mileage")
    out = _by_segment(df, [F.avg(m).alias("mean"), F.min(m).alias("min"), F.max(m).alias("max"), F.count(m).alias("count")], seg)
    median = quantile_columns(exact_quantiles(df.where(_c(seg).isNotNull()), ["Mileage"], [0.5], seg), {("Mileage", 0.5): "median"}, "segment")
    return out.join(median, "segment", "left").select("segment_order", "segment", "mean", "median", "min", "max",
                                                      F.coalesce("count", F.lit(0)).cast("bigint").alias("count")).orderBy("segment_order")


def limit_per_group(df: DataFrame, group: str, order: Iterable[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """First n rows per group by ``order`` (a bounded per-group cap that is the feature)."""
    w = Window.partitionBy(_c(group)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def head_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First n rows in a stated order (TakeOrderedAndProject)."""
    return df.orderBy(*[_c(o) for o in order]).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(_c(col)).filter(_c(col).isNotNull()).distinct().orderBy(_c(col))


def unpivot_metrics(df: DataFrame, ids: list[str], metrics: list[str], var: str = "metric",
                    value: str = "value") -> DataFrame:
    """Wide metric columns -> (ids..., metric, value) rows."""
    return df.unpivot([_c(i) for i in ids], [_c(m) for m in metrics], var, value)


# ---------------------------------------------------------------------------
# the whole segment report as one long table
# ---------------------------------------------------------------------------
CROSSTABS = [
    ("pct_by_make", "Car Make", SEG), ("pct_by_year", "Year of Manufacture", SEG),
    ("pct_financing", SEG, "Financing Support"), ("pct_fuel", SEG, "Fuel Type"),
    ("pct_transmission", SEG, "Transmission"), ("pct_drivetrain", SEG, "Drivetrain"),
    ("pct_exterior", SEG, "Top Exterior Color"), ("pct_state", SEG, "Top State"),
]


def with_top_columns(df: DataFrame) -> DataFrame:
    """Add 'Top Exterior Color' (else 'Other') and 'Top State' (else 'Unmatched')."""
    df = top_n_else_other(df, "Exterior", "Top Exterior Color", 5, "Other")
    return top_n_else_other(df, "State", "Top State", 5, "Unmatched")


def segment_report(df: DataFrame) -> DataFrame:
    """(section, segment, key, value) rows covering counts, every crosstab
    percentage, MPG, listed days and mileage statistics per segment. The
    input is materialised once (checkpoint in the shared folder) because
    every section of the union reads it; the eight crosstabs are one count."""
    df = with_top_columns(cut_lineage(df))
    parts = [segment_counts(df).select(F.lit("count").alias("section"), "segment",
                                       F.lit("n").alias("key"), F.col("n").cast("double").alias("value"))]
    parts.append(crosstab_many(df, CROSSTABS).select(F.col("crosstab").alias("section"), F.col("row_value").alias("segment"),
                                                     F.col("col_value").alias("key"), F.col("pct").alias("value")))
    mpg = segment_mpg(df)
    parts.append(unpivot_metrics(mpg, ["segment"], ["city_mpg", "highway_mpg"], "key", "value")
                 .select(F.lit("mpg").alias("section"), "segment", "key", "value"))
    ld = segment_listed_days(df)
    parts.append(ld.select(F.lit("listed_days").alias("section"), "segment", F.lit("mean").alias("key"),
                           F.col("listed_days").alias("value")))
    mi = segment_mileage(df).withColumn("count", F.col("count").cast("double"))
    parts.append(unpivot_metrics(mi, ["segment"], ["mean", "median", "min", "max", "count"], "key", "value")
                 .select(F.lit("mileage").alias("section"), "segment", "key", "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
