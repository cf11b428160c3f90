"""Benchmark decontamination: size-partitioned MinHash containment search.

Benchmark items are partitioned by their number of shingles into classes of
powers of two. For a class of up to 2^c shingles each document is read as
overlapping segments of two neighbouring blocks of 2^c shingles, so that an
item of that class, wherever it stands in a document of any length, lies in
one segment of comparable size and keeps a Jaccard similarity that MinHash can
see. An item is a candidate for a document when one of its minimum hashes
equals a segment's under the same hash function (bands of one row); items of a
single shingle are looked up by it. Candidates are verified by the exact share of
the item's distinct shingles that the whole document holds.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise
from .text import WORD, filled, mix64, pieces, word_shingles

SHINGLE, THRESHOLD, HASHES = 5, 0.8, 48
#: Distinct texts and their bytes in one broadcast index; a larger benchmark is searched in so many blocks of this size.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 1 << 24
SMALLEST_CLASS, LARGEST_CLASS = 1, 16
SCHEMA = "doc_id bigint, item string, containment double, n_matched int, n_shingles int"


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of ``n`` fixed hash functions."""
    x = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return x[:n] | np.uint64(1), x[n:]


def size_class(n: np.ndarray) -> np.ndarray:
    """c with 2^(c-1) < n <= 2^c, within the classes kept."""
    c = np.ceil(np.log2(np.maximum(n, 1))).astype(int)
    return np.clip(c, SMALLEST_CLASS, LARGEST_CLASS)


def _equal(values: np.ndarray, asked: np.ndarray, row: np.ndarray, items: np.ndarray, n_items: int) -> np.ndarray:
    """(row, item) pairs, as row * items + item, of equal entries of sorted ``values`` (of ``items``) and ``asked`` (of ``row``)."""
    left = np.searchsorted(values, asked, side="left")
    hit = np.flatnonzero((left < len(values)) & (values[np.minimum(left, len(values) - 1)] == asked))
    n = np.searchsorted(values, asked[hit], side="right") - left[hit]
    pick = np.repeat(left[hit], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    return np.repeat(row[hit].astype(np.int64), n) * n_items + items[pick]


class ItemIndex:
    """Sorted shingles of a block of items and, by size class and hash function, their sorted minimum hashes."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, k: int = SHINGLE, hashes: int = HASHES):
        h, row, _ = word_shingles(texts, k, WORD)
        pairs = np.unique(np.stack([row.astype(np.uint64), h], axis=1), axis=0) if len(h) else np.empty((0, 2), np.uint64)
        row, h = pairs[:, 0].astype(np.int64), pairs[:, 1]
        self.ids, self.k = ids, k
        self.size = np.bincount(row, minlength=len(ids))
        order = np.argsort(h, kind="stable")
        self.sh, self.sh_item = h[order], row[order]
        self.mul, self.add = _functions(hashes)
        classes = size_class(self.size)
        start = np.searchsorted(row, np.arange(len(ids)))
        self.one = np.flatnonzero(self.size[self.sh_item] == 1)  # where the only shingles of items stand among all
        live = np.flatnonzero(self.size > 1)
        self.tables: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        mins = [np.minimum.reduceat(h * m + a, start[live]) if len(live) else np.empty(0, np.uint64) for m, a in zip(self.mul, self.add)]
        for c in sorted(set(classes[live].tolist())):
            own = classes[live] == c
            self.tables[c] = []
            for v in mins:
                o = np.argsort(v[own], kind="stable")
                self.tables[c].append((v[own][o], live[own][o]))

    def candidates(self, h: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Distinct (row, item) pairs, as row * items + item, for shingles in text order."""
        found, n_items = [np.empty(0, np.int64)], len(self.ids)
        if len(h) and len(self.one):
            found.append(_equal(self.sh[self.one], h, row, self.sh_item[self.one], n_items))
        if not len(h) or not self.tables:
            return np.unique(np.concatenate(found))
        lo = min(self.tables)
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        begin = np.repeat(first, np.diff(np.r_[first, len(h)]))
        cut = np.flatnonzero(((np.arange(len(h)) - begin) & ((1 << lo) - 1)) == 0)  # first shingle of each block
        for j, (m, a) in enumerate(zip(self.mul, self.add)):
            at, block_row = cut, row[cut]
            low = np.minimum.reduceat(h * m + a, at)
            for c in range(lo, max(self.tables) + 1):
                if c > lo:  # pairs of blocks of the class below, counted from each row's start
                    head = np.flatnonzero(np.r_[True, block_row[1:] != block_row[:-1]])
                    index = np.arange(len(low)) - np.repeat(head, np.diff(np.r_[head, len(low)]))
                    keep = np.flatnonzero(index % 2 == 0)
                    low, block_row = np.minimum.reduceat(low, keep), block_row[keep]
                if c not in self.tables:
                    continue
                seg = low.copy()
                same = block_row[1:] == block_row[:-1]
                seg[:-1][same] = np.minimum(low[:-1], low[1:])[same]
                values, items = self.tables[c][j]
                found.append(_equal(values, seg, block_row, items, n_items))
        return np.unique(np.concatenate(found))

    def verify(self, h: np.ndarray, row: np.ndarray, cand: np.ndarray, threshold: float):
        """(row, item, matched) of candidates whose exact containment reaches the threshold."""
        if not len(cand):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        n_items = len(self.ids)
        wanted = np.zeros(int(row.max()) + 1, bool)
        wanted[cand // n_items] = True
        own = wanted[row]
        pairs = np.unique(np.stack([row[own].astype(np.uint64), h[own]], axis=1), axis=0)
        row, h = pairs[:, 0].astype(np.int64), pairs[:, 1]
        left, right = np.searchsorted(self.sh, h, "left"), np.searchsorted(self.sh, h, "right")
        n = right - left
        pick = np.repeat(left, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        key, matched = np.unique(np.repeat(row, n) * n_items + self.sh_item[pick], return_counts=True)
        ok = np.isin(key, cand) & (matched >= threshold * self.size[key % n_items] - 1e-9)
        return key[ok] // n_items, key[ok] % n_items, matched[ok]


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, hashes: int = HASHES,
               block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """One row per (document, item) with containment >= ``threshold``: doc_id,
    item_id, containment = n_matched / n_shingles (the item's distinct shingles of
    ``k`` lower-cased words; an item of fewer words is one shingle, found only in a
    document that is the same short sequence).

    Items without words never match; NULL texts count as empty; NULL ids are
    carried; repeated documents and items each give their own rows; empty tables
    give no rows; other columns are not read. The distinct texts of the benchmark
    are walked in blocks of about ``block_items`` texts or ``block_bytes`` bytes,
    each broadcast and compared with every document, so neither a broadcast nor a
    driver array grows with either table, however often an item is repeated; the ids
    are joined to what was found. Documents are not shuffled, so very long texts
    need no special care.
    """
    rows = _items(items, item_id_col, item_text_col)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for shared, ids in _blocks(rows, k, hashes, block_items, block_bytes):
        found = base.mapInArrow(_matches(shared, ids, k, threshold), SCHEMA)
        out = found if out is None else out.unionAll(found)
    return out.join(rows.select("item_id", "item"), "item").select("doc_id", "item_id", "containment", "n_matched", "n_shingles")


def _items(items: DataFrame, item_id_col: str, item_text_col: str) -> DataFrame:
    """(item_id, text, item): the rows of a benchmark, named by a hash of their text."""
    rows = items.select(F.col(item_id_col).cast("bigint").alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("item", F.sha2("text", 256))


def _blocks(rows: DataFrame, k: int, hashes: int, block_items: int, block_bytes: int):
    """(broadcast index, names of its texts) of each block of distinct texts; a block's expected size is bounded in texts and bytes."""
    texts = materialise(rows.where("text <> ''").select("item", "text").distinct())
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = max(1, -(-size["n"] // block_items), -(-size["bytes"] // block_bytes))
    for i in range(n):
        block = (texts if n == 1 else texts.where(F.pmod(F.xxhash64("item"), F.lit(n)) == i)).collect()
        held = pa.array([r["text"] for r in block], pa.large_string())
        yield rows.sparkSession.sparkContext.broadcast(ItemIndex(np.arange(len(block)), held, k, hashes)), [r["item"] for r in block]


def _found(col: pa.Array, index: ItemIndex, k: int, threshold: float):
    """(row, item, matched) arrays for each piece of a text column."""
    for lo, part in pieces(col):
        h, row, _ = word_shingles(part, k, WORD)
        r, item, matched = index.verify(h, row, index.candidates(h, row), threshold)
        yield lo + r, item, matched


def _matches(shared, ids, k, threshold):
    def run(batches):
        index = shared.value
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for r, item, matched in _found(filled(b.column(1)), index, k, threshold):
                if len(r):
                    size = index.size[item]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([doc_ids[x] for x in r], pa.int64()),
                        "item": pa.array([ids[x] for x in item], pa.string()),
                        "containment": pa.array(matched / size), "n_matched": pa.array(matched.astype(np.int32)),
                        "n_shingles": pa.array(size.astype(np.int32))})
    return run


def _clean(shared, k, threshold, text_at):
    def run(batches):
        index = shared.value
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            for r, _, _ in _found(filled(b.column(text_at)), index, k, threshold):
                keep[r] = False
            yield b.filter(pa.array(keep))
    return run


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, hashes: int = HASHES,
               block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in whose text ``find_leaks`` finds no
    item. Rows are judged where they lie, so nothing is shuffled or joined, and
    NULL or repeated ids make no difference."""
    at = docs.columns.index(text_col)
    for shared, _ in _blocks(_items(items, item_id_col, item_text_col), k, hashes, block_items, block_bytes):
        docs = docs.mapInArrow(_clean(shared, k, threshold, at), docs.schema)
    return docs
