import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from lotwise.llm import language_id as li

SYLLABLES = {"aa": "ka ro mi te su no".split(), "bb": "str eng icht ung pfe ßa".split(), "cc": "ñe eau oui lle ça tré".split()}


def _text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang], int(rng.integers(1, 4)))) for _ in range(n))


def _docs(n=240, seed=2):
    rng = np.random.default_rng(seed)
    langs = list(SYLLABLES)
    return [(i, _text(rng, langs[i % 3], int(rng.integers(1, 60))) + (".\n42!" if i % 5 == 0 else ""), langs[i % 3] if i % 7 else None) for i in range(n)]


def _chars(t):
    t = "".join(c.lower() if c.isalpha() else " " for c in t)
    return " ".join(t.split()) + " " if t.split() else ""


def _brute(train, order):
    """lang -> p(text) as sum of logs, with dictionaries."""
    raw = defaultdict(Counter)
    for text, lang in train:
        s = " " * (order - 1) + _chars(text)
        raw[lang].update(s[i - order + 1:i + 1] for i in range(order - 1, len(s)))
    tables = {}
    for lang, c in raw.items():
        t = {order: c}
        for k in range(order - 1, 0, -1):
            t[k] = Counter(g[1:] for g in t[k + 1])
        tables[lang] = t
    alphabet = len(set().union(*[t[1] for t in tables.values()])) + 1

    def p(lang, h, c, k):
        if k == 0:
            return 1 / alphabet
        t = tables[lang][k]
        n1, n2 = sum(v == 1 for v in t.values()), sum(v == 2 for v in t.values())
        d = max(0.1, min(0.95, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
        follow = [v for g, v in t.items() if g[:-1] == h]
        lower = p(lang, h[1:], c, k - 1)
        if not follow:
            return lower
        n = t.get(h + c, 0)
        return (max(n - d, 0) + d * len(follow) * lower) / sum(follow)

    def entropy(lang, text):
        s = " " * (order - 1) + _chars(text)
        return sum(math.log(p(lang, s[i - order + 1:i], s[i], order)) for i in range(order - 1, len(s)))

    return sorted(tables), entropy


def test_probabilities_equal_dictionaries_also_in_blocks(spark):
    rng = np.random.default_rng(0)
    train = [(_text(rng, lang, 6), lang) for lang in SYLLABLES for _ in range(4)]
    asked = ["karo micht", "ßung zzz oui", "Ñe! ñe", "x", "été ΑΒΓ", "", "12 3"]
    languages, entropy = _brute(train, 4)
    model = li.train(spark.createDataFrame(train, "text string, lang string"), 4)
    df = spark.createDataFrame([(t, i) for i, t in enumerate(asked)], "text string, __size int")
    for entries in (10 ** 6, 150):
        got, names = li.cross_entropies(df, model, 4, entries)
        assert names == languages
        rows = {r.text: r for r in got.collect()}
        for t in asked:
            assert rows[t]["__size"] == len(_chars(t))
            assert np.allclose(rows[t]["__sums"], [entropy(x, t) for x in languages], atol=1e-4), t
    assert len(list(li.model_blocks(model, 4, 150))) > 2


def test_held_out_accuracy_and_rejection(spark):
    rows = _docs()
    strange = [(9000 + i, " ".join(["ψωξ", "жщю", "ψωξ"] * 9), None) for i in range(4)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows + strange], "doc_id long, text string, lang string, score double").repartition(5)
    got = {r.doc_id: r for r in li.identify_languages(df).collect()}
    truth = {d: list(SYLLABLES)[d % 3] for d, _, _ in rows}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d in got)
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.95
    assert np.mean([got[d].score for d in held]) > 0.8 and np.mean([got[d].rejected for d in held]) < 0.1
    assert all(r.rejected and r.score < 0.2 for d, r in got.items() if d >= 9000)


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = _docs()
    moved = [(d, t, "bb" if zlib.crc32(str(d).encode()) % 4 == 2 else x) for d, t, x in rows]
    a, b = ({r.doc_id: (r.lang_pred, round(r.score, 9)) for r in li.identify_languages(spark.createDataFrame(x, "doc_id long, text string, lang string")).collect()}
            for x in (rows, moved))
    assert a == b


def test_nulls_empty_long_and_repeated(spark):
    rows = _docs() + [(None, "karo mite", "aa"), (500, None, "aa"), (501, "", None), (502, "12 34 !!", "bb"), (503, "́́", None),
                      (504, "karo suno " * 100_000, "aa"), (505, "karo", "aa"), (505, "karo", "aa")]
    got = li.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert all(by[d].lang_pred == "und" and by[d].score == 0 and by[d].rejected and by[d].cross_entropy is None for d in (500, 501, 502, 503))
    assert by[504].lang_pred == "aa" and by[None].lang_pred == "aa" and by[None].held_out is False
    assert len({tuple(r) for r in got if r.doc_id == 505}) == 1


def test_empty_unlabelled_and_one_language(spark):
    schema = "doc_id long, text string, lang string"
    assert li.identify_languages(spark.createDataFrame([], schema)).count() == 0
    alone = li.identify_languages(spark.createDataFrame([(1, "abc", None)], schema)).first()
    assert alone.lang_pred == "und" and alone.rejected
    one = li.identify_languages(spark.createDataFrame([(i, "karo mite", "aa") for i in range(40)], schema)).collect()
    assert {r.lang_pred for r in one} == {"aa"} and all(0 <= r.score <= 1 for r in one)
