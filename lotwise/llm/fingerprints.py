"""Document fingerprints: one-permutation MinHash.

Every shingle is hashed once; the hash picks a bin and competes there. Empty
bins are filled by optimal densification (bin i tries bins h(i, 1), h(i, 2), ...
until one is occupied and takes its value), and only the low-order bits of each
bin are stored. Two fingerprints agree by chance in a 2^-bits share of bins, so
the measured agreement a gives the likeness (a - c) / (1 - c), c = 2^-bits.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import WORD, filled, mix64, pieces, word_shingles

BINS, BITS, SHINGLE = 512, 4, 5
#: Range buckets a shuffle partition gets; buckets are dealt to partitions in turn.
BUCKETS_PER_PARTITION = 4
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def minhash_bins(h: np.ndarray, row: np.ndarray, n_rows: int, bins: int) -> np.ndarray:
    """(n_rows, bins) minimum hash of each bin; _EMPTY where no shingle fell."""
    out = np.full(n_rows * bins, _EMPTY, np.uint64)
    if len(h):
        slot = row.astype(np.int64) * bins + (h >> np.uint64(64 - int(bins).bit_length() + 1)).astype(np.int64)
        np.minimum.at(out, slot, h)
    return out.reshape(n_rows, bins)


def densify(sketch: np.ndarray) -> np.ndarray:
    """Fill the empty bins of every row that has an occupied one."""
    bins = sketch.shape[1]
    full = sketch != _EMPTY
    r, b = np.nonzero(~full & full.any(axis=1)[:, None])
    out = sketch.copy()
    attempt = 0
    while len(r):
        attempt += 1
        tries = mix64(np.arange(bins, dtype=np.uint64) + np.uint64(attempt << 32)) & np.uint64(bins - 1)
        src = tries.astype(np.int64)[b]
        hit = full[r, src]
        out[r[hit], b[hit]] = sketch[r[hit], src[hit]]
        r, b = r[~hit], b[~hit]
    return out


def fingerprints(col: pa.Array, bins: int = BINS, bits: int = BITS, k: int = SHINGLE) -> np.ndarray:
    """(rows, bins) low-order bits of the densified sketches of texts without
    NULLs; a text without words has the value 2^bits in every bin."""
    sketch = np.empty((len(col), bins), np.uint64)
    for lo, part in pieces(col):
        h, row, _ = word_shingles(part, k, WORD)
        sketch[lo:lo + len(part)] = minhash_bins(h, row, len(part), bins)
    dense = densify(sketch)
    low = (mix64(dense) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    low[(dense == _EMPTY).all(axis=1)] = 1 << bits
    return low


def pack(low: np.ndarray, bits: int = BITS) -> list[str]:
    """Hex strings of bins * bits / 4 digits; the empty text's is all zeros."""
    planes = (low[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    return [x.tobytes().hex() for x in np.packbits(planes.reshape(len(low), -1), axis=1)]


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bias-corrected similarity, row by row; 1 for two empty texts, 0 for one empty and one not."""
    chance = 2.0 ** -bits
    same = (a == b).mean(axis=1) if len(a) else np.empty(0)
    return np.clip((same - chance) / (1 - chance), 0.0, 1.0)


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _in_id_order(docs: DataFrame) -> DataFrame:
    """Rows as (bucket, border, doc_id, text), one range of ids a bucket, sorted
    inside by descending doc_id (NULL last, ties by text hash). The first row of
    each bucket also ends the bucket before it (border = 1), cyclically, so each
    row's successor stands next to it. The text moves once; only the bucket
    bounds (a number fixed by the partition count) reach the driver."""
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = parts * BUCKETS_PER_PARTITION
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("double"), [i / n for i in range(1, n)], max(10_000, 2 * n))).first()[0] or []
    cuts = sorted(set(cuts)) or [0.0]
    bucketed = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__key", outputCol="__bucket", handleInvalid="keep") \
        .transform(docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan"))))) \
        .withColumn("__null", F.col("doc_id").isNull()) \
        .select(F.when(F.col("__null"), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - F.col("__bucket").cast("int")).alias("bucket"),
                "doc_id", "text")  # bucket 0 has the largest ids, the last one the NULLs
    heads = sorted((r.bucket, r.doc_id) for r in bucketed.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).collect())
    links = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    border = spark.createDataFrame(links, "head bigint, to int")
    rows = bucketed.join(F.broadcast(border), bucketed.doc_id.eqNullSafe(border["head"]), "left")
    own = F.struct(F.col("bucket"), F.lit(0).alias("border"))
    copy = F.struct(F.col("to").alias("bucket"), F.lit(1).alias("border"))
    return rows.select(F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("at"), "doc_id", "text") \
        .select("at.bucket", "at.border", "doc_id", "text").repartitionById(parts, F.col("bucket")) \
        .sortWithinPartitions("bucket", "border", F.desc_nulls_last("doc_id"), F.xxhash64("text"))


def fingerprint_documents(docs: DataFrame, bins: int = BINS, bits: int = BITS, k: int = SHINGLE, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """One row per input row: the text's fingerprint, that of its edited text
    (the last floor(n_chars / 3) code points replaced by the first as many of
    the next document's, by descending doc_id, cyclically) and the likeness of
    the text's fingerprint to the edited text's and to the next document's.

    Shingles are ``k`` lower-cased words (fewer words: all of them). NULL text
    counts as empty; NULL ids come last in the order; rows that share an id are
    ordered by a hash of their text; a single row follows itself; an empty table
    gives an empty result; other columns are not read.
    """
    def chunks(batches) -> Iterator[list[tuple]]:
        """Consecutive rows; each list begins with the last row of the one before."""
        rows, size = [], 0
        for b in batches:
            for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), filled(b.column(3)).to_pylist()):
                rows.append(r)
                size += len(r[3])
                if size > 2_000_000:
                    yield rows
                    rows, size = rows[-1:], len(rows[-1][3])
        yield rows

    def run(batches):
        for rows in chunks(batches):
            if len(rows) < 2:
                continue
            low = fingerprints(pa.array([r[3] for r in rows], pa.large_string()), bins, bits, k)
            at = [i for i in range(len(rows) - 1) if rows[i][1] == 0 and rows[i][0] == rows[i + 1][0]]
            if not at:
                continue
            edited = []
            for i in at:
                text = rows[i][3]
                cut = len(text) // 3
                edited.append(text[:len(text) - cut] + rows[i + 1][3][:cut])
            changed = fingerprints(pa.array(edited, pa.large_string()), bins, bits, k)
            own = low[at]
            after = low[[i + 1 for i in at]]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([rows[i][2] for i in at], pa.int64()),
                "n_chars": pa.array([len(rows[i][3]) for i in at], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                "fingerprint": pa.array(pack(own, bits), pa.string()),
                "edited_fingerprint": pa.array(pack(changed, bits), pa.string()),
                "near_edited": pa.array(likeness(own, changed, bits)),
                "near_next": pa.array(likeness(own, after, bits))})

    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _in_id_order(base).mapInArrow(run, SCHEMA)
