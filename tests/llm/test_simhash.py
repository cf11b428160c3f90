import re

import numpy as np
import xxhash

from lotwise.llm import simhash as s
from lotwise.llm.components import connected_components


def brute_fp(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs, radius):
    """pairs of (id, fp) -> smallest id reachable."""
    root = {i: i for i, _ in pairs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(pairs):
        for j, b in pairs[:n]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in pairs}


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = {d: brute_fp(t) for d, t in rows}
    got = {r.doc_id: r for r in s.near_duplicates(docs.withColumn("fp", docs.n_chars)).collect()}
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    assert {d: r.component_id for d, r in got.items()} == brute_components(sorted(fps.items()), 4)


def test_links_in_crowded_and_split_shards(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base[:10]:
        x = int(b)
        for _ in range(60):
            for bit in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    pairs = sorted(enumerate(sorted(fps)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for _, f in pairs]
    df = spark.createDataFrame(signed, "fp bigint").repartition(3)
    want = brute_components(pairs, 4)
    for tree in (1024, 7):
        e = s.links(df, 4, tree)
        label = {r.node: r.root for r in connected_components(e).collect()}
        got = {}
        for i, f in pairs:
            v = f - (1 << 64) if f >> 63 else f
            got.setdefault(label.get(v, v), []).append(i)
        assert sorted(min(g) for g in got.values()) == sorted(set(want.values()))
        assert all(len({want[i] for i in g}) == 1 for g in got.values())


def test_masks_cover_every_pair():
    rng = np.random.default_rng(0)
    for n in (10, 10**8, 10**11):
        masks = s.block_masks(n, 4)
        for _ in range(200):
            flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(flips & m == 0 for m in masks)
    assert len(s.block_masks(10**8, 4)) > len(s.block_masks(10, 4)) == 5


def test_components_on_a_path_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, x) for x in range(501, 700)] + [(900, 900), (7, 6)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[x] == 500 for x in range(500, 700)) and 900 not in got


def test_nulls_ties_and_dedup(spark):
    text = "a b c d e f g h i j"
    rows = [(5, text, "x"), (3, text + " ", "y"), (3, text + " ", "y"), (None, text, None), (9, None, "z"), (8, "", None), (11, "q", None), (12, "Q", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.component_id) for r in s.near_duplicates(df).collect())
    assert got == [(-1, 3), (3, 3), (3, 3), (5, 3), (8, 8), (9, 8), (11, 11), (12, 11)]
    kept = s.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 8, 11]
    empty = df.limit(0)
    assert s.near_duplicates(empty).count() == 0 and s.drop_near_duplicates(empty).count() == 0
