"""Vectorised word and hash helpers over Arrow text columns.

All functions work on the raw UTF-8 bytes of whole texts (NULL counts as the
empty text). Intermediate arrays are a few times the size of one piece of a
batch, so callers walk a batch with ``pieces``; a text longer than the piece
limit stands alone.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_COMBINE = np.uint64(0xD6E8FEB86659FD93)
_tables: dict[str, np.ndarray] = {}

#: ASCII white space, as in [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Letters and digits; every byte of a multi-byte character counts as a letter.
WORD = np.zeros(256, bool)
WORD[128:] = True
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    WORD[_lo:_hi] = True


def filled(col: pa.Array) -> pa.Array:
    return pc.fill_null(col.cast(pa.large_string()), "")


def byte_view(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column without NULLs (see ``filled``)."""
    offs = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1 + col.offset)[col.offset:]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def pieces(col: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) with at most ``limit`` bytes a slice, one row at least."""
    if not len(col):
        return
    _, offs = byte_view(col)
    lo, n = 0, len(col)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, col.slice(lo, hi - lo)
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(name: str, base: int, n: int) -> np.ndarray:
    t = _tables.get(name)
    if t is None or len(t) < n:
        t = np.full(max(n, PIECE_BYTES + 1), np.uint64(base), np.uint64)
        t[0] = 1
        t = np.cumprod(t)
        _tables[name] = t
    return t[:n]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums, so that any substring hashes in O(1)."""
    n = len(buf)
    p = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _powers("pow", _BASE, n), out=p[1:])
    return p


def substring_hash(p: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of buf[s:e] for arrays of starts and ends, alike wherever they stand."""
    inv = _powers("inv", pow(_BASE, -1, 1 << 64), len(p))
    return mix64((p[e] - p[s]) * inv[s] + (e - s).astype(np.uint64) * _COMBINE)


def words(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of word bytes; runs never cross rows."""
    m = is_word[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before = np.empty(len(buf), bool)
    before[:1] = False
    before[1:] = m[:-1]
    s = np.flatnonzero(m & (~before | edge[:-1]))
    after = np.empty(len(buf), bool)
    after[-1:] = False
    after[:-1] = m[1:]
    e = np.flatnonzero(m & (~after | edge[1:])) + 1
    row = np.searchsorted(offs, s, side="right") - 1
    return s, e, row


def shingles(wh: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first word) of every run of ``k`` word hashes; a row with fewer
    words gives its whole sequence as one shingle, a row without words gives none."""
    n = len(wh)
    if not n:
        return wh, row, np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    count = np.diff(np.r_[first, n])
    h = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        h = h * _COMBINE + wh[j:n - k + 1 + j] if n >= k else h
    at = np.flatnonzero(row[:n - k + 1] == row[k - 1:]) if n >= k else np.empty(0, np.int64)
    short = count < k
    sf, sc = first[short], count[short]
    g = np.zeros(len(sf), np.uint64)
    for j in range(k - 1):
        live = sc > j
        g[live] = g[live] * _COMBINE + wh[sf[live] + j]
    g = mix64(g + sc.astype(np.uint64))
    h = mix64(h[at])
    if not len(sf):
        return h, row[at], at
    order = np.argsort(np.r_[at, sf], kind="stable")
    return np.r_[h, g][order], np.r_[row[at], row[sf]][order], np.r_[at, sf][order]


def word_shingles(col: pa.Array, k: int, is_word: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``shingles`` of a text column without NULLs; letters are lower-cased first."""
    buf, offs = byte_view(pc.utf8_lower(col))
    s, e, row = words(buf, offs, is_word)
    return shingles(substring_hash(prefix_sums(buf), s, e), row, k)
