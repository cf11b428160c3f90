"""Quality classifier: a sparse rule ensemble.

Boosted trees over text statistics give candidate rules (the path to each node
is a conjunction of threshold conditions); an L1-penalised logistic regression
weighs them and drops most; the rest are compiled into one Spark column
expression over the statistics, so scoring needs no model object.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import PIECE_BYTES, WORD, byte_view, filled, pieces, prefix_sums, shingles, substring_hash, words
from .trees import boost, paths, sigmoid

#: Labelled rows used for fitting, at most (a sample by hash of the id when there are more).
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
STATISTICS = ["log_bytes", "log_words", "word_bytes", "upper", "digits", "stops", "commas", "bangs", "bars", "symbols",
              "other_punct", "white", "lines", "non_ascii", "capitals", "short_words", "distinct_words", "top_word",
              "same_next", "distinct_shingles", "symbol_words"]


def _class(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SYMBOL = _class("#$%&*@^~<>{}[]\\_=+/")
_SETS = {"upper": _UPPER, "digits": _class("0123456789"), "stops": _class("."), "commas": _class(","), "bangs": _class("!?"),
         "bars": _class("|"), "symbols": _SYMBOL, "other_punct": _class("\"'`:;()-"), "white": _class(" \t"),
         "lines": _class("\n\r"), "non_ascii": np.arange(256) >= 128}


def text_statistics(col: pa.Array) -> np.ndarray:
    """(rows, len(STATISTICS)) statistics of whole texts without NULLs; an empty text has zeros."""
    out = np.zeros((len(col), len(STATISTICS)))
    for lo, part in pieces(col, PIECE_BYTES):
        buf, offs = byte_view(part)
        n, size = len(part), np.diff(offs).astype(float)
        per = np.maximum(size, 1)
        st = {}
        for name, table in _SETS.items():
            c = np.zeros(len(buf) + 1, np.int64)
            np.cumsum(table[buf], out=c[1:])
            st[name] = (c[offs[1:]] - c[offs[:-1]]) / per
        low, low_offs = byte_view(pc.utf8_lower(part))
        s, e, row = words(low, low_offs, WORD)
        count = np.bincount(row, minlength=n).astype(float)
        some = np.maximum(count, 1)
        share = lambda mask: np.bincount(row[mask], minlength=n) / some
        h = substring_hash(prefix_sums(low), s, e)
        st["log_bytes"], st["log_words"] = np.log1p(size), np.log1p(count)
        st["word_bytes"] = np.bincount(row, e - s, n) / some
        ps, _, prow = words(buf, offs, WORD)
        st["capitals"] = np.bincount(prow[_UPPER[buf[ps]]], minlength=n) / some
        st["short_words"] = share(e - s <= 3)
        after = np.minimum(e, max(len(low) - 1, 0))
        st["symbol_words"] = share(_SYMBOL[low[after]] & (e < low_offs[row + 1])) if len(low) else np.zeros(n)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        st["same_next"] = share(same)
        order = np.lexsort((h, row))
        hs, rs = h[order], row[order]
        new = np.r_[True, (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])] if len(hs) else np.empty(0, bool)
        st["distinct_words"] = np.bincount(rs[new], minlength=n) / some
        runs = np.diff(np.r_[np.flatnonzero(new), len(hs)])
        top = np.zeros(n)
        np.maximum.at(top, rs[new], runs)
        st["top_word"] = top / some
        g, grow, _ = shingles(h, row, 3)
        order = np.lexsort((g, grow))
        gs, rs = g[order], grow[order]
        new = np.r_[True, (gs[1:] != gs[:-1]) | (rs[1:] != rs[:-1])] if len(gs) else np.empty(0, bool)
        st["distinct_shingles"] = np.bincount(rs[new], minlength=n) / np.maximum(np.bincount(grow, minlength=n), 1)
        out[lo:lo + n] = np.stack([st[name] for name in STATISTICS], axis=1)
    return out


def stat_name(name: str) -> str:
    return f"__stat_{name}"


def with_statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus one double column per statistic; NULL text counts as empty."""
    at = docs.columns.index(text_col)
    kept = [i for i, c in enumerate(docs.columns) if keep is None or c in keep]
    names = [docs.columns[i] for i in kept] + [stat_name(s) for s in STATISTICS]

    def run(batches):
        for b in batches:
            x = text_statistics(filled(b.column(at)))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in kept] + [pa.array(x[:, j]) for j in range(x.shape[1])], names=names)

    schema = docs.select(*[docs.columns[i] for i in kept]).schema
    for s in STATISTICS:
        schema = schema.add(stat_name(s), "double")
    return docs.mapInArrow(run, schema)


@dataclass
class RuleModel:
    """Intercept and weighted rules; a rule is a tuple of (feature, is_high, cut)."""
    intercept: float
    rules: list[tuple[float, tuple]]

    def column(self) -> Column:
        """The probability of label 1 as a Spark expression over the statistic columns."""
        z = F.lit(self.intercept)
        for weight, conditions in self.rules:
            test = F.lit(True)
            for j, high, cut in conditions:
                c = F.col(stat_name(STATISTICS[j]))
                test = test & ((c > F.lit(cut)) if high else (c <= F.lit(cut)))
            z = z + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.intercept + rule_matrix([r for _, r in self.rules], x) @ np.array([w for w, _ in self.rules], float))


def rule_matrix(rules: list[tuple], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)), np.float32)
    for i, conditions in enumerate(rules):
        for j, high, cut in conditions:
            out[:, i] *= (x[:, j] > cut) if high else (x[:, j] <= cut)
    return out


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 250) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient for the L1-penalised logistic loss; the intercept is free."""
    m = np.c_[np.ones(len(a), np.float32), a]
    v = np.ones(m.shape[1]) / m.shape[1] ** 0.5
    for _ in range(8):  # largest eigenvalue of m'm / n, for the step
        v = m.T @ (m @ v) / len(m)
        norm = np.linalg.norm(v)
        v /= norm
    step = 4.0 / (1.05 * norm)
    w = np.zeros(m.shape[1])
    p = np.clip(y.mean(), 0.01, 0.99)
    w[0] = np.log(p / (1 - p))
    look, t = w.copy(), 1.0
    for _ in range(rounds):
        grad = m.T @ (sigmoid(m @ look) - y) / len(y)
        new = look - step * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        look, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, penalties=(0.01, 0.004, 0.0015, 0.0006)) -> RuleModel:
    """Fit on a bounded table of statistics. The penalty is the strongest whose
    log loss on a fifth of the rows is within 2 % of the best. Without rows the
    model gives 0.5, with one class a constant close to it."""
    if not len(y):
        return RuleModel(0.0, [])
    model = boost(x, y)
    rules = list(dict.fromkeys(p for t in model.trees for p in paths(t)))
    a = rule_matrix(rules, x)
    _, first = np.unique(a, axis=1, return_index=True)
    pick = [i for i in sorted(first) if 0 < a[:, i].sum() < len(a)]
    if not pick:
        return RuleModel(model.start, [])
    rules, a = [rules[i] for i in pick], a[:, pick]
    test = np.arange(len(y)) % 5 == 4
    loss = []
    for lam in penalties:
        b, w = _lasso(a[~test], y[~test], lam)
        p = np.clip(sigmoid(b + a[test] @ w), 1e-6, 1 - 1e-6)
        loss.append(-(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)).mean() if test.any() else 0.0)
    lam = next(q for q, v in zip(penalties, loss) if v <= 1.02 * min(loss) + 1e-9)
    b, w = _lasso(a, y, lam)
    return RuleModel(b, [(float(v), r) for v, r in zip(w, rules) if abs(v) > 1e-6])


def held_out(id_col: Column) -> Column:
    """Rows whose label is never learned: crc32(id as text) mod 4 = 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> RuleModel:
    """Fit on the documents labelled in ``labels`` outside the held-out part,
    ``max_rows`` of them at most: the sampled ids are a bounded broadcast, and the
    driver receives their statistics alone. NULL labels are not used; an id with
    several labels counts with the smallest."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))) \
        .groupBy(F.col(id_col).cast("bigint").alias("__id")).agg(F.min(label_col).cast("double").alias("__y"))
    sample = known.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    base = docs.select(F.col(id_col).cast("bigint").alias("__doc"), F.col(text_col).cast("string").alias("text"))
    rows = base.join(F.broadcast(sample), F.col("__doc") == F.col("__id")).select("__id", "__y", "text")
    got = with_statistics(rows, "text", ["__id", "__y"]).orderBy(F.xxhash64("__id"), "__id").limit(max_rows).toPandas()
    return fit_rules(got[[stat_name(s) for s in STATISTICS]].to_numpy(float), got["__y"].to_numpy(float))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score (probability of label 1), predicted (score >= threshold).

    Only statistics of the whole text enter a score. NULL and empty texts have
    zero statistics and are scored like any other; NULL ids are carried and never
    held out; repeated rows keep their rows; other columns are not read; an empty
    table gives no rows, no labels give the score 0.5. Documents are not shuffled.
    """
    model = train(docs, labels, max_rows, id_col, text_col)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_statistics(base, "text", ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column().alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier accepts."""
    model = train(docs, labels, max_rows, id_col, text_col)
    return with_statistics(docs, text_col).where(model.column() >= threshold).select(*docs.columns)
