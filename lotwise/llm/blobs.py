"""Moving many small records through Spark as few binary rows.

Tasks that make millions of short numeric records pack those of one bucket into
one row (byte planes, zstd), so that a shuffle moves a few compact rows and the
receiving task sorts plain arrays. Spark still deals the buckets to tasks.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard

#: Buckets for each shuffle partition. Buckets are dealt to partitions in turn (or by
#: hash, where both sides of a group come together).
BUCKETS_PER_PARTITION = 2


def bucket_count(spark) -> int:
    return BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(arrays: list[np.ndarray], widths: list[int]) -> bytes:
    """Low-order ``widths[i]`` bytes of each 64-bit array, plane by plane."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for a, w in zip(arrays, widths)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes, widths: list[int]) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n, at, out = len(raw) // sum(widths), 0, []
    for w in widths:
        a = np.zeros((n, 8), np.uint8)
        a[:, :w] = raw[at:at + n * w].reshape(w, n).T
        out.append(a.reshape(-1).view(np.int64))
        at += n * w
    return out


def deal(bucket: np.ndarray, arrays: list[np.ndarray], widths: list[int]) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed records) for each bucket that has records; order within a bucket is kept."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(own)]):
        at = order[lo:hi]
        yield int(own[lo]), pack([a[at] for a in arrays], widths)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys in sorted arrays."""
    n = len(keys[0])
    if not n:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
