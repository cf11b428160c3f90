"""Feature preparation as Spark plans: label codes, median fill, z-scores,
mode imputation and one-hot columns.

Whole-frame statistics (medians, means, modes) are one aggregate row joined
back on a constant key: a one-row broadcast, never a driver round trip.
Category values are counted for all columns in one pass; their codes are joined
on the value (a broadcast only where adaptive execution measures a small table;
otherwise a merge join whose hot values it splits).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .quantiles import exact_quantiles, quantile_columns


def _c(n: str) -> Column:
    return F.col(f"`{n}`")


def _with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row statistics frame to every row (broadcast, constant key)."""
    return df.withColumn("__k", F.lit(1)).join(F.broadcast(stats.withColumn("__k", F.lit(1))), "__k").drop("__k")


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) for every value of every column, NULL included, in one pass."""
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("value")) for c in cols]))
    return df.select(pair.alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("n"))


def category_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, code): codes 0..m-1 of each column in ascending value
    order; NULL, where it occurs, has the last code of its own. Values are ranked in ranges
    (running places plus the sizes of the ranges before), so no task holds a whole column's
    values; one row a range and column makes the offsets."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    values = category_counts(df, cols).select("column", "value").withColumn("last", F.col("value").isNull())
    tagged = cut_lineage(values.repartitionByRange(parts, "column", "last", "value").withColumn("pid", F.spark_partition_id()))
    before = Window.partitionBy("column").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tagged.groupBy("column", "pid").agg(F.count("*").alias("here")) \
        .select("column", "pid", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("pid", "column").orderBy("last", "value"))
    return cut_lineage(tagged.join(F.broadcast(offsets), ["column", "pid"])  # columns x partitions rows
                       .select("column", "value", (F.col("before") + place - 1).cast("int").alias("code")))


#: Codes up to which a column's codes are broadcast; more are joined once for all columns.
BROADCAST_CODES = 200_000
#: Copies of a code that the rows with its value are dealt over.
SALTS = 8


def label_encode(df: DataFrame, cols: list[str], suffix: str = "", codes: DataFrame | None = None) -> DataFrame:
    """Replace each column by its code. ``codes`` (default: fitted on ``df``)
    may come from another frame; a value it does not hold gets NULL.

    Few codes (counted) are broadcast, column by column, in one pass over the rows. Otherwise the
    rows' (column, value) pairs meet all codes in one join, salted so that a frequent value is no hot
    task, and come together again by row."""
    codes = codes if codes is not None else category_codes(df, cols)
    if codes.count() <= BROADCAST_CODES:
        out = df
        for c in cols:
            idx = codes.where(F.col("column") == c).select(F.col("value").alias("__v"), F.col("code").alias("__code"))
            out = out.join(F.broadcast(idx), _c(c).cast("string").eqNullSafe(F.col("__v")), "left").withColumn(c + suffix, F.col("__code")).drop("__v", "__code")
        return out
    rows = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))
    null, text = F.col("value").isNull().alias("null"), F.coalesce("value", F.lit("")).alias("value")
    pairs = rows.select("__row", F.pmod(F.xxhash64("__row"), F.lit(SALTS)).cast("int").alias("salt"),
                        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("string").alias("value")) for c in cols])).alias("p")) \
        .select("__row", "salt", "p.column", "p.value").select("__row", "salt", "column", null, text)
    dealt = codes.select("column", null, text, "code", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = pairs.join(dealt.hint("merge"), ["column", "null", "value", "salt"]).groupBy("__row") \
        .agg(*[F.max(F.when(F.col("column") == c, F.col("code"))).alias(f"__code{i}") for i, c in enumerate(cols)])
    return rows.join(found, "__row", "left").withColumns({c + suffix: F.col(f"__code{i}") for i, c in enumerate(cols)}) \
        .drop("__row", *[f"__code{i}" for i in range(len(cols))])


def fill_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULLs -> the column's exact median (see ``exact_quantiles``)."""
    df = cut_lineage(df)
    stats = quantile_columns(exact_quantiles(df, cols, [0.5]), {(c, 0.5): f"__med{i}" for i, c in enumerate(cols)})
    j = _with_stats(df, stats)
    return j.withColumns({c: F.coalesce(_c(c), F.col(f"__med{i}")) for i, c in enumerate(cols)}) \
            .drop(*[f"__med{i}" for i in range(len(cols))])


def scale_numeric(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """z-score with the population standard deviation (as StandardScaler)."""
    df, aggs = cut_lineage(df), []
    for i, c in enumerate(cols):
        aggs += [F.avg(_c(c)).alias(f"__mu{i}"), F.stddev_pop(_c(c)).alias(f"__sd{i}")]
    j = _with_stats(df, df.agg(*aggs))
    scaled = {c + suffix: F.when(F.col(f"__sd{i}") > 0, (_c(c) - F.col(f"__mu{i}")) / F.col(f"__sd{i}"))
                           .otherwise(F.lit(0.0)) for i, c in enumerate(cols)}
    return j.withColumns(scaled).drop(*[f"__{p}{i}" for i in range(len(cols)) for p in ("mu", "sd")])


def impute_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULLs -> the column's most frequent value (ties: the smallest), all columns from one count."""
    best = category_counts(df, cols).where("value IS NOT NULL").groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("best"))
    modes = best.agg(*[F.max(F.when(F.col("column") == c, F.col("best")["value"])).alias(f"__mode{i}") for i, c in enumerate(cols)])
    return _with_stats(df, modes).withColumns({c: F.coalesce(_c(c), F.col(f"__mode{i}").cast(df.schema[c].dataType)) for i, c in enumerate(cols)}) \
        .drop(*[f"__mode{i}" for i in range(len(cols))])


def one_hot_offsets(codes: DataFrame, cols: list[str]) -> tuple[dict[str, int], int]:
    """First indicator position of each column and the number of indicators; one row a column reaches the driver."""
    width = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count("*").alias("n")).collect()}
    offsets, at = {}, 0
    for c in cols:
        offsets[c] = at
        at += width.get(c, 0)
    return offsets, at


def one_hot(df: DataFrame, cols: list[str], codes: DataFrame, out: str = "hot") -> tuple[DataFrame, int]:
    """The positions of the indicators that are 1, in column order (the sparse form
    of a one-hot row; a value without a code has none), and the number of indicators."""
    offsets, width = one_hot_offsets(codes, cols)
    coded = label_encode(df, cols, "__code", codes)
    hot = F.filter(F.array(*[_c(c + "__code") + offsets[c] for c in cols]), lambda x: x.isNotNull())
    return coded.withColumn(out, hot).drop(*[c + "__code" for c in cols]), width
