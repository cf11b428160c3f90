import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lotwise.llm import token_counts as t

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["<|endoftext|> hi <|startoftext|>", "İstanbul Σας ΟΔΟΣ", "été   x\x85y\x1cz", "don't we'LL 123 ²½ ¾", "日本語 テスト", "", " \n\t ", "a" * 5000,
       "'S 's''re", "naïve ß ẞ Ǆ", "x<|endoftext|", "\x00\x01 \x7f", "é é", "µ ª º × ÷", "word " * 40_000, "<|endoftext|><|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    return lambda x: len(tok.encode(x or "", add_special_tokens=False).ids)


def test_whole_table_equals_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = docs.toPandas().set_index("doc_id").text
    got = t.count_tokens(docs.withColumn("n_tokens", docs.n_chars), PATH).collect()
    assert len(got) == len(text)
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len(text[r.doc_id].encode()), library(text[r.doc_id]))
        assert r.over_limit == (r.n_tokens > 2048) and 0 <= r.n_shortcut <= r.n_tokens


def test_odd_texts_nulls_ties_and_empty(spark, library):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)] + [(99, None), (None, "ab"), (7, ODD[7])], "doc_id long, text string")
    got = t.count_tokens(df, PATH, limit=10).collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        text = "ab" if r.doc_id is None else "" if r.doc_id == 99 else ODD[r.doc_id]
        assert r.n_tokens == library(text) and r.over_limit == (r.n_tokens > 10)
    assert t.count_tokens(df.limit(0), PATH).count() == 0


def test_shortcut_is_taken_beside_characters_outside_latin_1(spark, library):
    plain = "the house of the people, and the water " * 3
    texts = [plain, plain + "\u201cquoted\u201d", "\u2014 " + plain, plain + "\U0001f600", plain + "<|endoftext|>\u2019s", "Ωδη qzxqzy the \u201c"]
    got = sorted(t.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect())
    assert [r.n_tokens for r in got] == list(map(library, texts))
    assert got[0].n_shortcut > 20 and all(got[0].n_shortcut <= r.n_shortcut <= r.n_tokens for r in got[1:5])
    assert 1 <= got[5].n_shortcut < got[5].n_tokens


def test_proven_strings_are_single_tokens_and_the_cache_is_bounded(library, monkeypatch):
    proven = t.prove_single_tokens(PATH)
    assert len(proven) > 30_000 and proven == sorted(set(proven))
    assert all(library(p) == 1 for p in proven if t._PLAIN(p) and p == p.lower() and t._PRE(p) == [p])
    monkeypatch.setattr(t, "CACHE_WORDS", 3)
    counts = t._Counts(frozenset(["the"]), t._tokenizer(PATH).model)
    for w in ["qzx", "qzy", "qzw", "qzv", "the", "qzx"]:
        assert counts[w] == library(w)
    assert len(counts) <= 4 + 1
