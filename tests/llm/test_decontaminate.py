import re

import numpy as np
import pytest

from lotwise.llm.decontaminate import drop_leaks, find_leaks


def shingle_set(t, k=5):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, items, threshold=0.8):
    out = set()
    own = {i: shingle_set(t) for i, t in items}
    for d, t in docs:
        s = shingle_set(t)
        for i, q in own.items():
            if q and len(q & s) / len(q) >= threshold:
                out.add((d, i, len(q & s)))
    return out


@pytest.fixture(scope="module")
def case():
    rng = np.random.default_rng(3)
    vocab = [f"wé{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocab, int(n)))) for i, n in enumerate([3, 6, 12, 20, 33, 64, 65, 150, 400])]
    items += [(20, ""), (21, None), (22, items[3][1])]
    docs = []
    for i in range(200):
        w = list(rng.choice(vocab, int(rng.integers(0, 3000))))
        if i % 2:
            q = items[int(rng.integers(1, 9))][1].split()
            if i % 4 == 3 and len(q) > 30:
                q[len(q) // 2] = "changed"
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = q
        docs.append((i, (" " if i % 3 else "\n").join(w).upper() if i % 5 == 0 else " ".join(w)))
    return docs + [(900, items[0][1]), (901, None), (902, ""), (903, docs[1][1])], items


def test_equals_brute_force(spark, case):
    docs, items = case
    d = spark.createDataFrame([(a, b, 1.0) for a, b in docs], "doc_id long, text string, containment double")
    q = spark.createDataFrame(items, "item_id long, text string")
    for block in (20_000, 4):
        got = {(r.doc_id, r.item_id, r.n_matched) for r in find_leaks(d, q, block_items=block).collect()}
        assert got == brute(docs, items)
    kept = {r.doc_id for r in drop_leaks(d, q).collect()}
    assert kept == {x for x, _ in docs} - {x for x, _, _ in brute(docs, items)}


def test_empty_tables_and_null_ids(spark, case):
    docs, items = case
    q = spark.createDataFrame(items, "item_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert find_leaks(none, q).count() == 0
    d = spark.createDataFrame([(None, items[3][1])] * 2, "doc_id long, text string")
    assert find_leaks(d, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert find_leaks(d, q).count() == 4 and drop_leaks(d, q).count() == 0


def test_items_of_one_and_two_shingles_are_never_missed(spark):
    """A thousand five- and six-word items, each in the midst of a document of its own."""
    items = [(i, " ".join(f"q{i}x{j}" for j in range(5 + i % 2))) for i in range(1000)]
    docs = [(i, " ".join(f"d{i}y{j}" for j in range(i % 40)) + " " + q + " " + " ".join(f"d{i}z{j}" for j in range(60))) for i, q in items]
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(1000)]


def test_repeated_items_blocks_by_bytes_and_a_long_text(spark, case):
    docs, items = case
    many = items + [(None if i % 2 else 1000 + i, items[4][1]) for i in range(50)]
    d = spark.createDataFrame(docs + [(950, "filler " * 300_000 + items[5][1])], "doc_id long, text string")
    q = spark.createDataFrame(many, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.n_matched) for r in find_leaks(d, q, block_bytes=500).collect()), key=str)
    one = brute(docs, items) | {(950, items[5][0], len(shingle_set(items[5][1])))}
    assert got == sorted([x for x in one] + [(a, i, m) for a, q0, m in one if q0 == items[4][0] for i, _ in many[len(items):]], key=str)
