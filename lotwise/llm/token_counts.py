"""Token counts: the whole-token shortcut.

Offline, ``prove_single_tokens`` runs every vocabulary string that ends a word
through the tokenizer's own merge model and keeps those that come out as one
token; their counts are then known without any merge. ``count_tokens`` cuts
each whole text into the tokenizer's pre-tokens, counts the proven ones
directly and merges only the rest.
"""
from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import filled

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, n_shortcut bigint"
#: Learned counts of merged pre-tokens a task keeps at a time, and the longest one kept.
CACHE_WORDS, CACHE_CHARS = 200_000, 40
#: Texts of these characters alone need no normalisation but lower case, and
#: letters and digits among them are the ranges named in the pattern below.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ÿ]*").fullmatch
_PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+"
                  r"|[0-9²³¹¼-¾]"
                  r"|[^\sa-z0-9ªµºß-öø-ÿ²³¹¼-¾]+").findall


def byte_alphabet() -> dict[int, str]:
    """The visible character that byte-level vocabularies use for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in own}
    for i, b in enumerate(x for x in range(256) if x not in out):
        out[b] = chr(256 + i)
    return out


_BYTES = byte_alphabet()
_BACK = {c: b for b, c in _BYTES.items()}


def _form(plain: str) -> str:
    """A pre-token as byte-level vocabularies write it."""
    return "".join(_BYTES[b] for b in plain.encode())


def prove_single_tokens(path: str) -> list[str]:
    """The pre-tokens, as plain text, that the tokenizer file's model encodes alone as one token."""
    tok = _tokenizer(path)
    end = tok.model.end_of_word_suffix or ""
    special = set(tok.get_added_tokens_decoder())
    proven = []
    for s, i in tok.get_vocab(with_added_tokens=False).items():
        if i in special or not s.endswith(end) or s == end:
            continue
        form = s[:len(s) - len(end)]
        try:
            plain = bytes(_BACK[c] for c in form).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        got = tok.model.tokenize(form)
        if len(got) == 1 and got[0].id == i:
            proven.append(plain)
    return sorted(proven)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class _Counts(dict):
    """pre-token -> tokens. Starts with the proven ones; merges a missing one when first asked."""

    def __init__(self, proven, model):
        super().__init__(dict.fromkeys(proven, 1))
        self.proven, self.model, self.room, self.merged = proven, model, CACHE_WORDS, 0

    def __missing__(self, w: str) -> int:
        n = len(self.model.tokenize(_form(w)))
        if len(w) <= CACHE_CHARS:
            if not self.room:
                self.clear()
                self.update(dict.fromkeys(self.proven, 1))
                self.room = CACHE_WORDS
            self[w] = n
            self.room -= 1
        return n


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens as the tokenizers
    library gives them without added special tokens (a special token's string
    inside a text is one token, the library's default), over_limit
    (n_tokens > ``limit``), n_shortcut (pre-tokens counted without a merge).

    NULL and empty texts have 0 tokens; repeated rows and NULL ids each keep
    their row; other columns are not read. The broadcast table is bounded by
    the vocabulary. Needs no shuffle; each task keeps at most CACHE_WORDS merged
    pre-tokens. The tokenizer must be a BPE of this family: NFC, white space,
    lower case, then letters / single digits / other characters.
    """
    plain = prove_single_tokens(tokenizer_path)
    proven = docs.sparkSession.sparkContext.broadcast((frozenset(plain), frozenset(map(_form, plain))))

    def run(batches):
        tok = _tokenizer(tokenizer_path)
        specials = [t.content for t in tok.get_added_tokens_decoder().values()]
        cut = re.compile("|".join(map(re.escape, specials))).split if specials else lambda t: [t]
        (known, forms), normal, pre = proven.value, tok.normalizer.normalize_str, tok.pre_tokenizer.pre_tokenize_str
        counts, merges = _Counts(known, tok.model), tok.model.tokenize
        for b in batches:
            col = filled(b.column(1))
            n_tokens, n_short, n_bytes = [], [], []
            for text in col.to_pylist():
                n = short = 0
                n_bytes.append(len(text.encode()))
                parts = cut(text) if "<|" in text else [text]
                for part in parts:
                    if _PLAIN(part):
                        own = _PRE(part.lower())
                        n += sum(map(counts.__getitem__, own))
                        short += sum(map(known.__contains__, own))
                    else:
                        for form, _ in pre(normal(part)):
                            if form in forms:
                                n, short = n + 1, short + 1
                            else:
                                n += len(merges(form))
                n_tokens.append(n + len(parts) - 1)
                n_short.append(short)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "n_bytes": pa.array(n_bytes, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()),
                "over_limit": pa.array([n > limit for n in n_tokens], pa.bool_()), "n_shortcut": pa.array(n_short, pa.int64())})

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA)
