"""SimHash near-dedup with BK-trees.

Each whole text has a 64-bit fingerprint (a bit is set when it is set in more
than half of its shingles' XXH64 hashes). Fingerprints within the radius link.

Links are found shard by shard: the 64 bits are cut into m blocks, and two
fingerprints within distance r agree in at least m - r blocks, so every link
lies in a shard "same bits in these m - r blocks". In a shard a BK-tree holds
the fingerprints (children keyed by their integer distance to the parent) and a
search follows only edges within the radius of the query's distance. Shards are
dealt by a shuffle and each tree lives in the task that holds its shard: a
driver broadcast of shard trees would pass all fingerprints through the driver.
"""
from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import materialise

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints in one tree; a larger shard is compared tree by tree, in all pairs of its trees.
TREE = 1024
#: Mean shard size up to which the number of blocks is not raised.
SHARD = 2000
_LEAF = 24


def fingerprint(text: bytes, k: int = SHINGLE, seed: int = SEED) -> int:
    """Words are runs without ASCII white space, A-Z lower-cased; fewer words than
    ``k`` make one shingle; a text without words has the fingerprint 0."""
    w = text.lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= k:
        return xxhash.xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, w), np.int64, len(w))
    end = np.cumsum(size + 1) - 1
    hash64 = xxhash.xxh64_intdigest
    h = np.array([hash64(joined[a:b], seed) for a, b in zip((end - size)[:len(w) - k + 1].tolist(), end[k - 1:].tolist())], np.uint64)
    count = np.zeros(64, np.int64)
    for lo in range(0, len(h), 65_536):
        part = h[lo:lo + 65_536]
        count += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) per input row; fp as a signed long."""
    def run(batches):
        for b in batches:
            fp = [fingerprint(t or b"", k) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fp, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id bigint, fp bigint")


class BkTree:
    """A BK-tree over positions of an array of fingerprints, searched for many queries at a time."""

    def __init__(self, fps: np.ndarray, at: np.ndarray):
        self.at, self.fps, self.children = at, fps, []
        if len(at) > _LEAF:  # fewer are one leaf, compared directly
            self.at, rest = at[:1], at[1:]
            d = np.bitwise_count(fps[rest] ^ fps[at[0]])
            order = np.argsort(d, kind="stable")
            edges, first = np.unique(d[order], return_index=True)
            for edge, own in zip(edges.tolist(), np.split(rest[order], first[1:])):
                self.children.append((edge, BkTree(fps, own)))

    def search(self, queries: np.ndarray, radius: int, out: list) -> None:
        """Appends (query position, tree position) arrays of pairs within the radius."""
        d = np.bitwise_count(self.fps[queries][:, None] ^ self.fps[self.at][None, :])
        q, t = np.nonzero(d <= radius)
        if len(q):
            out.append((queries[q], self.at[t]))
        if self.children:
            d = d[:, 0].astype(np.int16)
            for edge, child in self.children:
                near = queries[np.abs(d - edge) <= radius]
                if len(near):
                    child.search(near, radius, out)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions over pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def shard_links(fps: np.ndarray, side: np.ndarray, i: int, j: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links found with the tree of chunk ``i`` and the queries of chunk ``j``, reduced to a star a component."""
    tree_at, query_at = np.flatnonzero(side == i), np.flatnonzero(side == j)
    found: list = []
    if len(tree_at) and len(query_at):
        BkTree(fps, tree_at).search(query_at, radius, found)
    if not found:
        return fps[:0], fps[:0]
    root = local_roots(len(fps), np.concatenate([q for q, _ in found]), np.concatenate([t for _, t in found]))
    own = np.flatnonzero(root != np.arange(len(fps)))
    return fps[own], fps[root[own]]


def block_masks(n: int, radius: int, shard: int = SHARD) -> list[int]:
    """Bit masks whose shards together hold every pair within the radius: each
    choice of m - radius out of m blocks. m grows with the number of
    fingerprints until a shard of evenly spread ones has at most ``shard``."""
    m = radius + 1
    while n >> (64 * (m - radius) // m) > shard and comb(m + 1, radius) <= 500:
        m += 1
    cuts = [64 * i // m for i in range(m + 1)]
    block = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(m)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(m), m - radius)]


def links(distinct: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect exactly
    those that chains of pairs within ``radius`` connect: one star for every local
    component, so a group of g close fingerprints gives O(g) rows, not all pairs."""
    if radius == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    masks = F.array(*[F.lit(signed(m)).cast("bigint") for m in block_masks(distinct.count(), radius)])
    rows = distinct.select("fp", F.posexplode(masks).alias("shard", "mask")).select("fp", "shard", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))
    large = rows.groupBy("shard", "bits").agg(F.count("*").alias("n")).where(F.col("n") > tree) \
        .select("shard", "bits", F.ceil(F.col("n") / tree).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp", F.lit(7)), F.coalesce("chunks", F.lit(1))).cast("int")
    dealt = rows.join(large, ["shard", "bits"], "left").withColumn("side", chunk) \
        .select("fp", "shard", "bits", "side", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("other")) \
        .select("fp", "shard", "bits", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    group = ["shard", "bits", "i", "j"]
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, *group).sortWithinPartitions(*group).mapInArrow(_link_groups(radius), "a bigint, b bigint")


def _link_groups(radius: int):
    """Groups arrive sorted; the rows of the last group of a batch wait for the next batch."""
    names = ["shard", "bits", "i", "j", "side", "fp"]

    def linked(x: dict[str, np.ndarray], whole: bool):
        key = np.stack([x[c] for c in names[:4]])
        first = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]) if key.shape[1] else np.empty(0, np.int64)
        bounds = [*first.tolist(), key.shape[1]]
        done = len(bounds) - 1 if whole else len(bounds) - 2
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo, hi in zip(bounds[:max(done, 0)], bounds[1:]):
            if hi - lo > 1:
                u, v = shard_links(x["fp"][lo:hi].view(np.uint64), x["side"][lo:hi], x["i"][lo], x["j"][lo], radius)
                a.append(u.view(np.int64))
                b.append(v.view(np.int64))
        rest = bounds[done] if done >= 0 else 0
        return np.concatenate(a), np.concatenate(b), {c: v[rest:] for c, v in x.items()}

    def run(batches):
        held = {c: np.empty(0, np.int64) for c in names}
        for batch in batches:
            own = {c: np.concatenate([held[c], batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)]) for c in names}
            a, b, held = linked(own, False)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        a, b, _ = linked(held, True)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, radius: int = RADIUS, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id,
    the smallest doc_id reachable over links of at most ``radius`` differing bits.

    NULL and empty texts have the fingerprint 0 and link like any other. A NULL
    id never is a component's id unless all ids of the component are NULL.
    Repeated rows and ids keep their rows; other columns are not read; an empty
    table gives no rows. Equal fingerprints are collapsed before any search, and
    a crowded shard is split into trees of ``TREE``, so neither a large group of
    copies nor one of near copies meets in one task.
    """
    own = materialise(fingerprints(docs, k, id_col, text_col))
    return _components(own, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _components(own: DataFrame, radius: int) -> DataFrame:
    first = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("first")))
    label = materialise(connected_components(links(first.select("fp"), radius)))
    member = materialise(label.join(first, label.node == first.fp).select("fp", "root", "first"))
    least = materialise(member.groupBy("root").agg(F.min("first").alias("least")))
    linked = member.join(least, "root").select("fp", "least")
    of = materialise(first.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")))
    return own.join(of, "fp")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are the first (smallest id) of
    their component. Rows with a NULL id belong to no decision and stay. Rows
    that share an id count as one document: one of them stays, if the id stays."""
    own = materialise(fingerprints(docs, k, id_col, text_col).where("doc_id IS NOT NULL"))
    judged = materialise(_components(own, radius).groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n")))
    key = F.col(id_col).cast("bigint")
    drop = judged.where(~F.col("stays")).select(F.col("doc_id").alias("__drop"))
    # a merge join at every size: the dropped ids grow with the corpus, so they are no broadcast
    kept = docs.join(drop.hint("merge"), key == F.col("__drop"), "left_anti")
    repeated = judged.where("stays AND n > 1").select(F.col("doc_id").alias("__again"))
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, key == F.col("__again"), "left_anti").unionByName(
        kept.join(repeated, key == F.col("__again"), "left_semi").dropDuplicates([id_col]))
