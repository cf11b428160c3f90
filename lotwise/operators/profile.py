"""Whole-frame statistics: describe, profile, quality, correlation, box plots,
histograms. Each is one (or two) aggregation passes; nothing is collected.
Frames that need two passes are materialised first."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .quantiles import exact_quantiles, quantile_columns


def _c(n: str) -> Column:
    return F.col(f"`{n}`")


def _stack(one_row: DataFrame, names: list[str], fields: list[str], key: str = "column") -> DataFrame:
    """One wide aggregate row (columns named '<i>__<field>') -> one row per name."""
    structs = [F.struct(F.lit(n).alias(key), *[F.col(f"`{i}__{f}`").alias(f) for f in fields])
               for i, n in enumerate(names)]
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact, linear), max per column."""
    df = cut_lineage(df.select(*[_c(c) for c in cols]))
    aggs = []
    for i, c in enumerate(cols):
        x = _c(c).cast("double")
        aggs += [F.count(x).alias(f"{i}__count"), F.avg(x).alias(f"{i}__mean"),
                 F.stddev_samp(x).alias(f"{i}__std"), F.min(x).alias(f"{i}__min"), F.max(x).alias(f"{i}__max")]
    plain = _stack(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    wide = q.groupBy("column").agg(*[F.max(F.when(F.col("q") == x, F.col("value"))).alias(n) for n, x in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))])
    return plain.join(wide, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def column_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) for every column, one pass."""
    names = df.columns
    one = df.agg(*[F.count(_c(c)).alias(f"{i}__non_null") for i, c in enumerate(names)])
    out = _stack(one, names, ["non_null"])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    tmap = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(types[n]))])
    return out.select("column", F.element_at(tmap, F.col("column")).alias("dtype"), "non_null")


def quality_metrics(df: DataFrame, price: str = "Cash Price (USD)") -> DataFrame:
    """(metric, value): total rows, NULLs per column, price min/max/mean."""
    names = df.columns
    aggs = [F.count(F.lit(1)).cast("double").alias("total_rows")]
    aggs += [F.sum(F.when(_c(c).isNull(), 1).otherwise(0)).cast("double").alias(f"missing:{c}") for c in names]
    aggs += [F.min(_c(price)).cast("double").alias("price_min"), F.max(_c(price)).cast("double").alias("price_max"),
             F.avg(_c(price)).alias("price_mean")]
    one = df.agg(*aggs)
    return one.unpivot([], [F.col(f"`{a}`") for a in one.columns], "metric", "value")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair (pairwise complete rows); long
    form (col_a, col_b, corr), both orders plus the diagonal; NULL below two rows
    or without variance.

    The means come first (one row); then each task adds up the centred moments of
    all pairs as matrix products and sends one row a pair."""
    base = cut_lineage(df.select(*[_c(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]))
    k = len(cols)
    mean = np.array([x or 0.0 for x in base.agg(*[F.avg(f"c{i}") for i in range(k)]).first()])

    def moments(batches):
        total = np.zeros((4, k, k))
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(k)])
            there = ~np.isnan(x)
            x, m = np.where(there, x - mean, 0.0), there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *[pa.array(t.ravel()) for t in total], pa.array(total[1].T.ravel()), pa.array(total[2].T.ravel())],
                                         names=["i", "j", "n", "sx", "sxx", "sxy", "sy", "syy"])

    rows = base.mapInArrow(moments, "i bigint, j bigint, n double, sx double, sxx double, sxy double, sy double, syy double")
    t = rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy", "sy", "syy")])
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n"), F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    corr = F.when((F.col("n") > 1) & (F.col("i") == F.col("j")), F.lit(1.0)).when((F.col("n") > 1) & (vx > 0) & (vy > 0),
                                                                                  (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(vx * vy))
    name = F.array(*[F.lit(c) for c in cols])
    return t.select(F.get(name, F.col("i").cast("int")).alias("col_a"), F.get(name, F.col("j").cast("int")).alias("col_b"), corr.alias("corr"))


#: Groups up to which their fences are broadcast.
BROADCAST_GROUPS = 100_000


def boxplot_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: q1, median, q3, whiskers (furthest data within 1.5 IQR of the
    box) and the outlier count. Quartiles first, then one pass over the rows
    joined to their group's fences: by broadcast where the groups are few (counted), so a
    frequent group is no hot task; otherwise groups are small."""
    v = _c(value).cast("double")
    base = cut_lineage(df.filter(_c(group).isNotNull() & v.isNotNull()).select(_c(group).alias("grp"), v.alias("v")))
    q = quantile_columns(exact_quantiles(base, ["v"], [0.25, 0.5, 0.75], "grp"), {("v", 0.25): "q1", ("v", 0.5): "median", ("v", 0.75): "q3"}, "grp")
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    q = cut_lineage(q)
    j = base.join(F.broadcast(q) if q.count() <= BROADCAST_GROUPS else q, "grp")
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    return j.groupBy("grp", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("n_outliers"),
        F.count(F.lit(1)).alias("n")).withColumnRenamed("grp", group)


def histogram_by_group(df: DataFrame, group: str, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the global [min, max] of ``value``, counted per
    group; the last bin is closed on the right. The global bounds are one
    aggregate row joined on a constant key (a one-row broadcast)."""
    v = _c(value).cast("double")
    base = cut_lineage(df.filter(v.isNotNull() & _c(group).isNotNull()).select(_c(group).alias("grp"), v.alias("v"))) \
        .withColumn("__k", F.lit(1))
    bounds = base.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).withColumn("__k", F.lit(1))
    j = base.join(F.broadcast(bounds), "__k")
    span = F.col("hi") - F.col("lo")
    b = F.when(span == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) * float(bins) / span) + 1, F.lit(bins))).cast("int")
    return (j.withColumn("bin", b).groupBy("grp", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("grp").alias(group), "bin",
                      (F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / float(bins)).alias("bin_lo"),
                      "n"))
