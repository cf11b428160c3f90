import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa

from lotwise.llm import importance as im

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))


def _features(t, n):
    w = _words(t)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % im.BUCKETS for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def _brute(docs, target, n=1, least=20, percent=10):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(_features(x, n))
    for x in target:
        t.update(_features(x, n))
    sa, ta = sum(s.values()) + 10000.0, sum(t.values()) + 10000.0
    gain = [math.floor(1000 * math.log((t[k] + 1.0) * sa / ((s[k] + 1.0) * ta))) for k in range(im.BUCKETS)]
    rows = []
    for d, x in docs:
        f = _features(x, n)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[k] for k in f)
        rows.append([d, len(_words(x)), len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3]))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[5] = i + 1
    return sorted(map(tuple, rows), key=str)


def _docs():
    rows = [(i, " ".join(f"wörd{(i * j * 7) % 50} Ab,c{j % 9}" for j in range(i % 45))) for i in range(150)]
    rows += [(None, "Same words " * 12), (None, "same words " * 12), (200, None), (201, ""), (202, "\x00a\x00b\x7f"), (203, "long " * 300_000),
             (-5, "tie " * 25), (-5, "tie " * 25), (-6, "\U0001F600 　é" * 30)]
    return rows


def test_equals_brute_force(spark):
    rows, target = _docs(), ["wörd7 ab c3", "TIE tie", None, ""]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, rank int, score int").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    for n, percent in ((1, 10), (3, 50)):
        got = im.resample(df, bench, max_n=n, percent=percent).collect()
        assert sorted(map(tuple, got), key=str) == _brute(rows, target, n, percent=percent)


def test_runs_do_not_cross_documents():
    b, row, words = im.batch_features(pa.array(["a b", "", "c", "A  b!"], pa.large_string()), 2)
    assert words.tolist() == [2, 0, 1, 2]
    assert sorted(zip(row.tolist(), b.tolist())) == sorted((i, k) for i, t in enumerate(["a b", "", "c", "A  b!"]) for k in _features(t, 2))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert im.resample(none, none).count() == 0
    one = spark.createDataFrame([(1, "x " * 30)], "doc_id long, text string")
    assert im.resample(one, none, percent=100).first().rank == 1
    assert im.resample(one, none).first().rank is None


def test_ranks_of_a_large_tie(spark):
    scored = spark.range(3000).selectExpr("id AS doc_id", "30L AS n_words", "30L AS n_features", "5L AS weight", "CASE WHEN id % 3 = 0 THEN 7L ELSE id END AS score")
    got = im.rank_highest(scored, 2500).collect()
    want = sorted(got, key=lambda r: (-r.score, r.doc_id))
    assert [r["rank"] for r in want] == [*range(1, 2501), *[None] * 500]
