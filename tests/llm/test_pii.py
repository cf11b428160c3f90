import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import pii


def plain(text):
    """The definition, applied literally."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        tot = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and tot % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(s, e, pii.KINDS[k]) for s, k, e in sorted(out)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@-+ 0123456789(é%\n", max_size=60))
def test_base_spans_follow_the_definition(t):
    assert pii.base_spans(t) == plain(t)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "@", ".", "-", " ", "1.2.3.4", "256", "4444 3333-2222 1111", "4111111111111111", "+1 (017) 555-7713", "x_y", "0"]), max_size=9))
def test_base_spans_on_glued_parts(parts):
    t = "".join(parts)
    assert pii.base_spans(t) == plain(t)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = docs.toPandas().set_index("doc_id").text
    got = pii.find_pii(docs.withColumn("spans", docs.n_chars)).collect()
    assert len(got) == len(text)
    added = 0
    for r in got:
        base = plain(text[r.doc_id])
        every = r.spans.split(",") if r.spans else []
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[2] == k for b in base) for k in pii.KINDS[:4])
        assert {f"{k}:{s}:{e}" for s, e, k in base} <= set(every) and len(every) == len(base) + r.n_added
        added += r.n_added
        for s in set(every) - {f"{k}:{s}:{e}" for s, e, k in base}:
            assert s.startswith("secret:")
    assert added == sum(len(re.findall(r'token = "[0-9a-f]{40}"', t)) for t in text) > 0


def test_trees_rank_variants(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = pii.train_spans(docs)
    rows = [r for i, t in enumerate(docs.select("text").toPandas().text[:1500]) for r in pii.training_rows(t, i)]
    p = model.boosted.predict(np.array([r[0] for r in rows]))
    y = np.array([r[1] for r in rows])
    assert ((p > 0.5) == y).mean() > 0.95
    text = "write to jane.21 at mail3 dot example dot com or see page 12 at home"
    assert [k for _, _, k in model.extra(text, pii.base_spans(text))] == ["email"]


def test_redaction_nulls_long_and_empty(spark):
    rows = [(1, None, "x", 0), (None, "", None, None), (2, "a b@c.d e", "x", 9), (2, "a b@c.d e", "x", 9), (3, "9" * 50_000 + "a" * 50_000 + "@", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    model = pii.fit_spans(np.empty((0, len(pii.FEATURES))), np.empty(0), [])
    out = sorted(pii.redact_pii(docs, model=model).collect(), key=str)
    assert [r.text for r in out if r.doc_id == 2] == ["a [EMAIL] e"] * 2 and [r.n_chars for r in out if r.doc_id == 2] == [11, 11]
    assert [r.text for r in out if r.doc_id == 1] == [None] and pii.find_pii(docs).count() == 5
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_generators_have_no_length_cap_and_no_blanks_at_the_ends():
    for n in (16, 128, 129, 1000, 100_000):
        token = ("0a1b2c3d" * (n // 8 + 1))[:n]
        assert (9, 9 + n, "secret") in pii.candidates(f'token = "{token}"') or (7, 9 + n, "secret") in pii.candidates(f'token= "{token}"')
    long_mail = "a" * 90 + " at " + "b" * 80 + " dot c dot d dot e dot f dot g dot com"
    assert (0, len(long_mail), "email") in pii.candidates(long_mail)
    for t in ("call me at 001 415 555-2671", "tel (415) 555-2671", "x +1 415 555 2671 y", "+ 1 415 555 2671"):
        for s, e, kind in pii.candidates(t):
            if kind == "phone":
                assert t[s:e] == t[s:e].strip(), t
    assert (11, 27, "phone") in pii.candidates("call me at 001 415 555-2671")
