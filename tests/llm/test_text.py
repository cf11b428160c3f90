import re

import numpy as np
import pyarrow as pa

from lotwise.llm import blobs
from lotwise.llm import text as t


def test_words_and_shingles_equal_plain_python():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("aB é1_ .\n"), int(n))) for n in rng.integers(0, 60, 200)] + ["", "x", "a b c d e", "A B C D E"]
    col = t.filled(pa.array(texts + [None]))
    h, row, first = t.word_shingles(col, 5)
    seen = {}
    want = []
    for i, x in enumerate(texts + [""]):
        w = re.findall(r"[^\W_]+", x.lower())
        want += [(i, j, tuple(w[j:j + 5])) for j in range(max(1, len(w) - 4))] if w else []
    assert len(want) == len(h)
    for (i, _, s), x, r in zip(want, h.tolist(), row.tolist()):
        assert r == i and seen.setdefault(s, x) == x
    assert len(set(seen.values())) == len(seen)


def test_pieces_cover_all_rows_and_long_texts_stand_alone():
    col = t.filled(pa.array(["a" * n for n in (0, 5, 50, 3, 0, 9)]))
    got = list(t.pieces(col, 10))
    assert [lo for lo, _ in got] == [0, 2, 3, 5] and sum(len(p) for _, p in got) == 6
    assert list(t.pieces(col.slice(0, 0))) == []


def test_substring_hash_is_the_same_anywhere():
    buf = np.frombuffer(b"xxabcyyabc", np.uint8)
    p = t.prefix_sums(buf)
    a, b, c = t.substring_hash(p, np.array([2, 7, 3]), np.array([5, 10, 6]))
    assert a == b != c


def test_packed_records_round_trip():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 1 << 40, 1000), rng.integers(0, 200, 1000), rng.integers(-5, 5, 1000)]
    widths = [5, 1, 8]
    back = blobs.unpack(blobs.pack(arrays, widths), widths)
    assert all((a == b).all() for a, b in zip(arrays, back))
    bucket = rng.integers(0, 7, 1000)
    got = dict(blobs.deal(bucket, arrays, widths))
    for k, data in got.items():
        assert (blobs.unpack(data, widths)[0] == arrays[0][bucket == k]).all()
    assert list(blobs.deal(bucket[:0], [a[:0] for a in arrays], widths)) == []
    assert blobs.runs(np.array([1, 1, 2, 2]), np.array([0, 0, 0, 1])).tolist() == [0, 2, 3]
