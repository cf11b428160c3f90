"""The listing model: fitted encoding, truncated SVD + k-means clusters, exact
neighbours and Weibull time-to-sell scores, all as Spark plans."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .clusters import Clusters, fit_clusters, nearest_centre
from .encode import category_codes, label_encode, one_hot_offsets
from .knn import knn_join
from .quantiles import exact_quantiles, quantile_columns
from .selltime import score_frame
from .tall_qr import row_products, sparse_svd

NUMERIC = ["Year of Manufacture", "Cash Price (USD)", "Mileage", "City MPG", "Highway MPG"]
CATEGORICAL = ["Car Make", "Exterior", "Interior", "Fuel Type", "Transmission", "Drivetrain", "Engine",
               "Financing Support", "State"]
TIME = "Listed Days"
SVD_COMPONENTS, CLUSTERS, NEIGHBOURS, SEED = 15, 8, 20, 42
#: Features up to which the products of all pairs of features are summed.
SQUARED_FEATURES = 1000
PREDICTION_FIELDS = ["cluster", "current_listing_days", "expected_days_to_sell", "total_expected_days",
                     "probability_sold_30days", "days_to_sell_25p", "days_to_sell_median", "days_to_sell_75p",
                     "similar_cars_count", "similar_cars_median_days", "cluster_median_days", "weibull_shape",
                     "weibull_scale"]


def _c(n: str) -> Column:
    return F.col(f"`{n}`")


@dataclass
class Encoding:
    """What the catalogue fixes for itself and for new listings: medians, means and
    standard deviations of the numbers, the category codes and their indicator positions."""
    median: dict[str, float]
    mean: dict[str, float]
    std: dict[str, float]
    codes: DataFrame
    offsets: dict[str, int]
    width: int


def _z(enc: Encoding, name: str) -> Column:
    x = F.coalesce(_c(name).cast("double"), F.lit(enc.median[name]))
    return (x - F.lit(enc.mean[name])) / F.lit(enc.std[name]) if enc.std[name] else F.lit(0.0)


def fit_encoding(catalogue: DataFrame) -> Encoding:
    """Fitted on a catalogue of listings (rows with a VIN). Six medians, means and
    deviations and nine widths reach the driver."""
    names = NUMERIC + [TIME]
    q = quantile_columns(exact_quantiles(catalogue, names, [0.5]), {(c, 0.5): c for c in names}).first()
    median = {c: float(q[c]) if q is not None and q[c] is not None else 0.0 for c in names}
    filled = [F.coalesce(_c(c).cast("double"), F.lit(median[c])) for c in names]
    row = catalogue.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)], *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)]).first()
    codes = category_codes(catalogue, CATEGORICAL)
    offsets, width = one_hot_offsets(codes, CATEGORICAL)
    return Encoding(median, {c: float(row[f"m{i}"] or 0.0) for i, c in enumerate(names)}, {c: float(row[f"s{i}"] or 0.0) for i, c in enumerate(names)}, codes, offsets, width)


def encode(df: DataFrame, enc: Encoding) -> DataFrame:
    """(VIN, Listed Days, z of the five numbers, z of Listed Days, codes): codes
    holds one category code a column, -1 for a value the catalogue does not have."""
    coded = label_encode(df, CATEGORICAL, "__code", enc.codes)
    return coded.select("VIN", F.coalesce(_c(TIME).cast("double"), F.lit(enc.median[TIME])).alias(TIME),
                        F.array(*[_z(enc, c) for c in NUMERIC]).alias("z"), _z(enc, TIME).alias("z_time"),
                        F.array(*[F.coalesce(_c(c + "__code"), F.lit(-1)) for c in CATEGORICAL]).alias("codes"))


def _dense_and_hot(b: pa.RecordBatch, offsets: np.ndarray):
    """Per batch: the dense features (five numbers, Listed Days) and the feature index of each category (-1: none)."""
    z = b.column("z").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
    codes = b.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
    dense = np.c_[z, b.column("z_time").to_numpy(zero_copy_only=False)]
    return dense, np.where(codes < 0, -1, codes + offsets[None, :] + dense.shape[1])


def _times(dense: np.ndarray, hot: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Rows of the sparse feature matrix times ``v``."""
    out = dense @ v[:dense.shape[1]]
    for j in range(hot.shape[1]):
        has = hot[:, j] >= 0
        out[has] += v[hot[has, j]]
    return out


def _entries(encoded: DataFrame, enc: Encoding) -> DataFrame:
    """(row, feature, x) of the sparse feature matrix; ``encoded`` carries __row."""
    dense = F.concat(F.col("z"), F.array("z_time"))
    base = len(NUMERIC) + 1
    numbers = F.transform(dense, lambda x, i: F.struct(i.cast("bigint").alias("feature"), x.alias("x")))
    offsets = F.array(*[F.lit(enc.offsets[c] + base) for c in CATEGORICAL])
    hot = F.filter(F.transform("codes", lambda c, i: F.struct(F.when(c >= 0, (c + offsets[i]).cast("bigint")).alias("feature"), F.lit(1.0).alias("x"))),
                   lambda e: e["feature"].isNotNull())
    return encoded.select(F.col("__row").alias("row"), F.explode(F.concat(numbers, hot)).alias("e")).select("row", "e.feature", "e.x")


def truncated_svd(encoded: DataFrame, enc: Encoding, k: int = SVD_COMPONENTS) -> np.ndarray | DataFrame:
    """The top-k right singular vectors (no centring) of the features of ``encode``'s rows.

    Up to SQUARED_FEATURES features one pass adds up the products of all pairs of features, and their
    eigenvectors come back as a (features, k) matrix. With more features the vectors are a
    table (feature, v) that no task or driver holds whole (``tall_qr``). Signs: the largest
    entry of a vector is positive."""
    d = len(NUMERIC) + 1 + enc.width
    if d > SQUARED_FEATURES:
        rows = cut_lineage(encoded.withColumn("__row", F.monotonically_increasing_id()))
        return sparse_svd(_entries(rows, enc), k)[0]
    offsets = np.array([enc.offsets[c] for c in CATEGORICAL])

    def run(batches):
        total = np.zeros(d * d)
        for b in batches:
            dense, hot = _dense_and_hot(b, offsets)
            n = dense.shape[1]
            at = np.c_[np.tile(np.arange(n), (len(dense), 1)), hot]
            x = np.c_[dense, np.ones(hot.shape)]
            for j in range(at.shape[1]):
                ok = (at >= 0) & (at[:, j] >= 0)[:, None]
                total += np.bincount((at[:, j, None] * d + at)[ok], (x[:, j, None] * x)[ok], d * d)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(own.astype(np.int32)), "part": pa.array(total[own])})

    gram = np.zeros(d * d)
    for r in encoded.mapInArrow(run, "pair int, part double").groupBy("pair").agg(F.sum("part")).collect():  # SQUARED_FEATURES squared at most
        gram[r[0]] = r[1]
    gram = gram.reshape(d, d)
    v = np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1][:, :k]
    return v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])


def project(encoded: DataFrame, enc: Encoding, v: np.ndarray | DataFrame, out: str = "svd") -> DataFrame:
    """``encoded`` plus the features times ``v`` (array<double>)."""
    if isinstance(v, DataFrame):  # one vector a feature: joined on the features of the rows
        rows = cut_lineage(encoded.withColumn("__row", F.monotonically_increasing_id()))
        first = v.first()
        if first is None:
            return encoded.withColumn(out, F.array().cast("array<double>"))
        return rows.join(row_products(_entries(rows, enc), v, len(first.v)).withColumnsRenamed({"row": "__row", "v": out}), "__row").drop("__row")
    offsets = np.array([enc.offsets[c] for c in CATEGORICAL])
    shared = encoded.sparkSession.sparkContext.broadcast(v)

    def run(batches):
        for b in batches:
            y = _times(*_dense_and_hot(b, offsets), shared.value)
            yield b.append_column(out, pa.array(list(y), pa.list_(pa.float64())))

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))]))


def kmeans_fit(df: DataFrame, col: str = "svd", k: int = CLUSTERS, seed: int = SEED, like: Clusters | None = None) -> Clusters:
    """Centres that do not depend on the order of the rows; a refit keeps the labels of the centres ``like``."""
    return fit_clusters(df, k, seed, col, "VIN", like=like)


def kmeans_cluster(df: DataFrame, model: Clusters, col: str = "svd") -> DataFrame:
    """``df`` plus the nearest centre of the fitted k-means."""
    return nearest_centre(df, model, col)


@dataclass
class ListingModel:
    """Everything that scoring takes from the catalogue."""
    encoding: Encoding
    components: np.ndarray | DataFrame
    kmeans: Clusters
    catalogue: DataFrame  # encoded rows with their cluster
    stats: DataFrame      # per cluster


def fit_model(analysis: DataFrame) -> ListingModel:
    base = cut_lineage(analysis.filter(_c("VIN").isNotNull()).select("VIN", *[_c(c) for c in NUMERIC + CATEGORICAL + [TIME]]))
    enc = fit_encoding(base)
    encoded = cut_lineage(encode(base, enc))
    v = truncated_svd(encoded, enc)
    placed = cut_lineage(project(encoded, enc, v))
    km = kmeans_fit(placed)
    catalogue = cut_lineage(kmeans_cluster(placed, km))
    return ListingModel(enc, v, km, catalogue, cut_lineage(cluster_stats(catalogue)))


def cluster_stats(df: DataFrame, cluster: str = "cluster", value: str = TIME) -> DataFrame:
    """count, min, max, mean, median, sample std of ``value`` per cluster."""
    v = _c(value)
    plain = df.groupBy(cluster).agg(F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
                                    F.stddev_samp(v).alias("std"))
    median = quantile_columns(exact_quantiles(df, [value], [0.5], cluster), {(value, 0.5): "median"}, cluster)
    return plain.join(median, cluster, "left").select(cluster, "count", "min", "max", "mean", "median", "std")


def cluster_stats_lookup(df: DataFrame, stats: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Attach cluster median/mean/std to each row (k-row broadcast)."""
    s = stats.select(cluster, F.col("median").alias("cluster_median"), F.col("mean").alias("cluster_mean"),
                     F.col("std").alias("cluster_std"))
    return df.join(F.broadcast(s), cluster, "left")


def neighbour_days(neigh: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(qid, days): the neighbours' Listed Days in neighbour-rank order. At
    most k values per query, so the per-query list is bounded."""
    nd = neigh.join(catalogue.select(F.col("VIN").alias("nid"), _c("Listed Days").alias("nd")), "nid")
    return nd.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "nd"))).alias("__l")).select(
        "qid", F.transform("__l", lambda s: s["nd"]).alias("days"))


def score_rows(rows: DataFrame, catalogue: DataFrame, stats: DataFrame, k: int = NEIGHBOURS, exclude_self: bool = False,
               include_listed_days: bool = True) -> DataFrame:
    """Prediction fields of rows that carry z, codes, cluster and Listed Days, from their
    neighbours in ``catalogue`` and the clusters' ``stats``."""
    neigh = knn_join(rows.select(F.col("VIN").alias("qid"), F.col("z").alias("vec"), "codes"),
                     catalogue.select(F.col("VIN").alias("nid"), F.col("z").alias("vec"), "codes"), k, codes="codes", exclude_self=exclude_self)
    days = neighbour_days(neigh, catalogue).withColumnRenamed("qid", "VIN")
    scored = cluster_stats_lookup(rows.select("VIN", "cluster", _c(TIME)), stats).join(days, "VIN")
    return score_frame(scored, "days", "cluster_median", "cluster_mean", TIME, include_listed_days).select("VIN", *PREDICTION_FIELDS)


def score_all(analysis: DataFrame, k: int = NEIGHBOURS, exclude_self: bool = False, model: ListingModel | None = None) -> DataFrame:
    """Prediction fields for every listing of the catalogue (in-sample: a listing
    is its own nearest neighbour unless ``exclude_self``)."""
    model = model or fit_model(analysis)
    return score_rows(model.catalogue, model.catalogue, model.stats, k, exclude_self)


def score_new(new_cars: DataFrame, model: ListingModel, k: int = NEIGHBOURS) -> DataFrame:
    """Score listings outside the catalogue with the catalogue's fitted state: its
    codes (an unknown value has no indicator), medians, scaling, components and
    centres; Listed Days = 0 and unconditional probabilities. Neighbours come
    from the catalogue."""
    rows = cut_lineage(encode(new_cars.where(_c("VIN").isNotNull()).withColumn(TIME, F.lit(0.0)), model.encoding))
    placed = kmeans_cluster(project(rows, model.encoding, model.components), model.kmeans)
    return score_rows(cut_lineage(placed), model.catalogue, model.stats, k, include_listed_days=False)


def cluster_outcome_stats(pred: DataFrame, days: DataFrame) -> DataFrame:
    """Per cluster: mean/median of expected days and 30-day probability,
    count/mean/median of listed days (flat column names)."""
    j = cut_lineage(pred.join(days.select("VIN", _c(TIME)), "VIN"))
    plain = j.groupBy("cluster").agg(
        F.avg("expected_days_to_sell").alias("expected_days_mean"), F.avg("probability_sold_30days").alias("p30_mean"),
        F.count(_c(TIME)).alias("listed_days_count"), F.avg(_c(TIME)).alias("listed_days_mean"))
    names = {"expected_days_to_sell": "expected_days_median", "probability_sold_30days": "p30_median", TIME: "listed_days_median"}
    median = quantile_columns(exact_quantiles(j, list(names), [0.5], "cluster"), {(c, 0.5): out for c, out in names.items()}, "cluster")
    return plain.join(median, "cluster", "left").select("cluster", "expected_days_mean", "expected_days_median", "p30_mean", "p30_median",
                                                        "listed_days_count", "listed_days_mean", "listed_days_median")


def combine_predictions(clean: DataFrame, pred: DataFrame) -> DataFrame:
    """Cleaned rows + the last four prediction columns, matched on VIN
    (row position has no meaning in a distributed frame)."""
    last4 = pred.select("VIN", F.col("expected_days_to_sell").alias("Expected_Days_To_Sell"),
                        F.col("probability_sold_30days").alias("Probability_Sold_30Days"),
                        F.col("total_expected_days").alias("Total_Expected_Days"), F.col("cluster").alias("Cluster"))
    return clean.join(last4, "VIN", "left")

