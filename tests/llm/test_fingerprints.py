import hashlib
import re

import numpy as np
import pyarrow as pa

from lotwise.llm import fingerprints as fp


def _brute(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 3
        out[d] = (len(t), hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest())
    return out


def _jaccard(a, b):
    sets = []
    for t in (a, b):
        w = re.findall(r"[^\W_]+", t.lower())
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


def test_order_edit_and_likeness(spark):
    rng = np.random.default_rng(1)
    vocab = [f"wörd{i}" for i in range(4000)]
    rows = [(int(i * 7 - 50), " ".join(rng.choice(vocab, int(rng.integers(60, 400))))) for i in range(300)]
    rows += [(5001, None), (5002, ""), (5003, rows[3][1]), (5004, rows[3][1]), (5005, "x " * 40_000)]
    df = spark.createDataFrame([(d, t, "junk") for d, t in rows], "doc_id long, text string, fingerprint string").repartition(7)
    got = {r.doc_id: r for r in fp.fingerprint_documents(df).collect()}
    want = _brute(rows)
    assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == want
    assert got[5003].fingerprint == got[5004].fingerprint == got[rows[3][0]].fingerprint
    assert got[5002].near_next == 1.0 and got[5003].near_next == 0.0 and got[5001].n_chars == 0
    order = sorted(rows, key=lambda r: -r[0])
    err = []
    for i, (d, t) in enumerate(order):
        if t and len(t) > 300 and d < 5000:
            cut = len(t) // 3
            err.append(got[d].near_edited - _jaccard(t, t[:len(t) - cut] + (order[(i + 1) % len(order)][1] or "")[:cut]))
    assert abs(np.mean(err)) < 0.01 and np.std(err) < 0.04


def test_null_ids_ties_single_and_empty(spark):
    schema = "doc_id long, text string"
    assert fp.fingerprint_documents(spark.createDataFrame([], schema)).count() == 0
    one = fp.fingerprint_documents(spark.createDataFrame([(4, "a b c d e f")], schema)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    rows = [(None, "n one"), (None, "n two"), (2, "same"), (2, "same"), (2, "other")]
    assert fp.fingerprint_documents(spark.createDataFrame(rows, schema)).count() == 5


def test_densification_fills_every_bin_and_is_fair():
    low = fp.fingerprints(pa.array(["one", "one", "two", ""], pa.large_string()))
    assert (low[0] == low[1]).all() and (low[3] == 16).all() and (low[:3] < 16).all()
    assert fp.likeness(low[:1], low[2:3])[0] < 0.15
