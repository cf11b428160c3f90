"""Embedding whitening by spectral divide and conquer.

The covariance of the distinct vectors is split by polar decompositions: the
orthogonal polar factor U of V - sigma I (QDWH iteration) has eigenvalues +1 and
-1, so (I + U) / 2 projects on the eigenvectors above the shift and (I - U) / 2 on
those below. Bases of both give two smaller problems, split again until blocks
hold one eigenvalue. The components (dimensions x 16 numbers) are broadcast and
every row is projected on them.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
#: floor(64 c) is held as a 32-bit integer; entries beyond it are set to the limit.
LIMIT = 2 ** 31 - 1
_EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Orthogonal polar factor of a square matrix by the QDWH iteration: weights from a
    lower bound of the smallest singular value, one QR factorisation of the stacked
    matrix a round, until the iterate stands still."""
    size = np.linalg.norm(a)
    d = len(a)
    if size == 0:
        return np.eye(d)
    x, low = a / size, _EPS
    for _ in range(rounds):
        low = min(low, 1.0)
        g = np.cbrt(4 * (1 - low * low) / low ** 4)
        wa = np.sqrt(1 + g) + 0.5 * np.sqrt(max(0.0, 8 - 4 * g + 8 * (2 - low * low) / (low * low * np.sqrt(1 + g))))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(d)]))
        y = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * q[:d] @ q[d:].T
        low = low * (wa + wb * low * low) / (1 + wc * low * low)
        step = np.linalg.norm(y - x)
        x = y
        if step < 1e-14 * np.sqrt(d) and low > 1 - 1e-14:
            break
    return (x + x.T) / 2


def _range(p: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal basis (d, k) of the range of a projector of rank ``k``."""
    q, _ = np.linalg.qr(p @ rng.standard_normal((len(p), k)))
    q, _ = np.linalg.qr(p @ q)
    return q


def _split(a: np.ndarray, basis: np.ndarray, scale: float, rng: np.random.Generator, wanted: int, out: list) -> None:
    """Append (eigenvalue, vector) pairs of the block, highest first, until ``wanted`` are found."""
    k = len(a)
    mean = np.trace(a) / k
    if k == 1 or np.abs(a - mean * np.eye(k)).max() <= 4 * _EPS * scale:
        out.extend((float(a[i, i]), basis[:, i]) for i in range(k))
        return
    spread = np.linalg.norm(a - mean * np.eye(k)) / np.sqrt(k)
    for nudge in (0.0, 0.11, -0.13, 0.29, -0.31, 0.05, -0.07, 0.47, -0.43, 0.017, -0.023):
        u = polar_factor(a - (mean + nudge * spread) * np.eye(k))
        top = (np.eye(k) + u) / 2
        n = round(float(np.trace(top)))
        if 0 < n < k and np.abs(top @ top - top).max() < 1e-12:  # no eigenvalue on the shift
            break
    else:
        # Eigenvalues too close to part: they are equal within rounding.
        out.extend(sorted(((float(a[i, i]), basis[:, i]) for i in range(k)), key=lambda t: -t[0]))
        return
    above = _range(top, n, rng)
    below = _range(np.eye(k) - top, k - n, rng)
    for q in (above, below):
        if len(out) < wanted:
            block = q.T @ a @ q
            _split((block + block.T) / 2, basis @ q, scale, rng, wanted, out)


def principal_components(cov: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the ``wanted`` largest
    eigenvalues of a symmetric matrix; those within rounding of zero are left out."""
    d = len(cov)
    if not d or not np.abs(cov).max() > 0:
        return np.empty(0), np.empty((d, 0))
    scale = float(np.linalg.norm(cov))
    out: list = []
    _split(cov, np.eye(d), scale, np.random.default_rng(7), wanted, out)
    v = np.column_stack([x / np.linalg.norm(x) for _, x in out])
    e = np.einsum("ij,ik,kj->j", v, cov, v)
    order = np.argsort(-e, kind="stable")[:wanted]
    order = order[e[order] > 8 * d * _EPS * scale]
    return e[order], v[:, order]


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, k): floor(64 c) of each entry as integers; rows whose vector is NULL or
    holds NULL, NaN or infinite entries are left out."""
    e = F.col(vec_col).cast("array<double>")
    whole = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    k = F.transform(e, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return vectors.where(e.isNotNull() & F.coalesce(F.forall(e, whole), F.lit(False))) \
        .select(F.col(id_col).cast("bigint").alias("vec_id"), k.alias("k"))


def _matrix(col, d: int) -> np.ndarray:
    """(rows, d) integers of an Arrow list column."""
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(col), d)


def _summed(fit: DataFrame, d: int, size: int, per_block) -> np.ndarray:
    """Sum over all rows of ``per_block(matrix) -> flat array``: one partial row a task, added up
    by Spark entry by entry; ``size`` numbers reach the driver."""
    def part(batches):
        total = None
        for b in batches:
            if len(b):
                got = per_block(_matrix(b.column(0), d))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(total.dtype)))})

    kind = "bigint" if per_block(np.zeros((1, d), np.int64)).dtype.kind == "i" else "double"
    out = np.zeros(size, np.int64 if kind == "bigint" else float)
    for r in fit.mapInArrow(part, f"v array<{kind}>").select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r.v
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per kept vector and component: (vec_id, component, n, deviation, whitened,
    explained, identity_error).

    Entries become x = floor(64 c) + 1,000,000. Mean, covariance and components come from
    the distinct vectors (the fit list of n vectors with sums S); the covariance is centred
    before multiplying. deviation is the exact sum of (n x - S)^2, NULL if it exceeds a long;
    whitened is x - S / n on the component over sqrt(eigenvalue); identity_error is the
    largest absolute entry of the whitened fit list's covariance minus the identity.

    Vectors that are NULL or hold NULL or non-finite entries are dropped. If lengths differ,
    vectors of the most frequent length (the longest of equally frequent ones) are kept.
    Entries beyond 32 bits after scaling are set to that limit. Equal vectors count once in
    the fit list and keep a row each; NULL ids are kept. Directions without variance
    have no component, so one vector, equal vectors or an empty table give an empty result.
    Other columns are not read. Memory beside the rows: dimensions x dimensions numbers.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = quantised(vectors, id_col, vec_col)
    common = rows.groupBy(F.size("k").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None or common.d == 0:
        return spark.createDataFrame([], schema)
    d = common.d
    rows = rows.where(F.size("k") == d)
    fit = materialise(rows.select("k").distinct())

    sums = _summed(fit, d, d + 1, lambda m: np.append(m.sum(axis=0), len(m)))
    n, s = int(sums[d]), sums[:d]  # sums of k; x is k + 1,000,000
    whole = s // n
    rest = (s - n * whole) / n
    centred = lambda m: (m - whole) - rest

    def products(m):
        c = centred(m)
        return (c.T @ c).ravel()

    cov = (_summed(fit, d, d * d, products) / n).reshape(d, d)
    cov = (cov + cov.T) / 2
    e, v = principal_components(cov, components)
    k = len(e)
    if not k:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(v / np.sqrt(e))

    def moments(m):
        z = centred(m) @ shared.value
        return np.r_[(z.T @ z).ravel(), z.sum(axis=0)]

    got = _summed(fit, d, k * k + k, moments) / n
    error = float(np.abs(got[:k * k].reshape(k, k) - np.outer(got[k * k:], got[k * k:]) - np.eye(k)).max())
    explained = e / np.trace(cov)

    def project(batches):
        for b in batches:
            m = _matrix(b.column(1), d)
            r = len(m)
            y = n * (m - whole) - (s - n * whole)
            size = np.einsum("ij,ij->i", y.astype(float), y.astype(float))
            exact = np.einsum("ij,ij->i", y, y)
            yield pa.RecordBatch.from_pydict({
                "vec_id": b.column(0).take(pa.array(np.repeat(np.arange(r), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                "n": pa.array(np.full(r * k, n, np.int64)),
                "deviation": pa.array(np.repeat(exact, k), mask=np.repeat(size > 9.2e18, k)),
                "whitened": pa.array((centred(m) @ shared.value).ravel()),
                "explained": pa.array(np.tile(explained, r)),
                "identity_error": pa.array(np.full(r * k, error))})

    return rows.mapInArrow(project, schema)
