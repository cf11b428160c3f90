"""PII: candidate gradient boosting.

Exact base patterns find the certain cases. High-recall generators then propose
overlapping candidate spans (digit groups, dotted quads, written-out e-mail
addresses, key-like strings); boosted trees rate them by format and context
features, and a threshold calibrated for each kind selects further spans that
do not overlap what is already chosen.
"""
from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialise
from .text import filled
from .trees import Boosted, apply_tree, boost_counted, coded, counted_cuts, decoded, frontier, histogram, quantile_cuts

#: Different points (of as many bytes as there are features) up to which the driver grows the trees by itself.
DRIVER_POINTS = 100_000
#: A kind's threshold keeps at least this share of right spans on calibration rows, and is never below MIN_SCORE.
PRECISION, MIN_SCORE = 0.98, 0.9
KINDS = ["email", "ip", "card", "phone", "secret"]
CONTEXT = 32
SCHEMA = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, "
          "n_added bigint")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP_RUN = re.compile(r"[0-9][0-9.]{6,}").finditer
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}").finditer
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_DIGIT = re.compile(r"[0-9]").search


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octet(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) < 4 and int(p or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind; leftmost and without overlap within a kind."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:  # the local part reaches back to the last match or "@", so nothing is scanned twice
        lo = at
        while lo > free and text[lo - 1] in _LOCAL:
            lo -= 1
        host = _DOMAIN(text, at + 1) if lo < at else None
        free = host.end() if host else at + 1
        if host:
            found.append((lo, free, 0))
        at = text.find("@", at + 1)
    if _DIGIT(text):
        for run in _IP_RUN(text):
            if run[0].count(".") >= 3:
                found += [(run.start() + m.start(), run.start() + m.end(), 1) for m in _IP(run[0]) if all(_octet(p) for p in m[0].split("."))]
        for m in _CARD(text):
            if m.end() - m.start() >= 14:
                digits = re.sub(r"[\x20-]", "", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), m.end(), 3))
    found.sort(key=lambda s: (s[0], s[2]))
    return [(s, e, KINDS[k]) for s, e, k in found]


#: Generators: kind, a cheap test that must hold, and the pattern of a proposal.
_GENERATORS = [
    ("email", lambda t: "@" in t or "[at]" in t or "(at)" in t or (" at " in t and " dot " in t),
     re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]+(?:(?:\.|\x20dot\x20|\x20?\[dot\]\x20?)[A-Za-z0-9-]+)+").finditer),
    ("ip", _DIGIT, re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[.\x20,][0-9]{1,3}){3}(?![0-9.])").finditer),
    ("card", _DIGIT, re.compile(r"(?<![0-9])[0-9](?:[\x20.-]{0,2}[0-9]){11,18}(?![0-9])").finditer),
    ("phone", _DIGIT, re.compile(r"(?<![0-9])(?:(?:\+|00)\x20?)?\(?[0-9]{1,4}\)?(?:[\x20./()-]{1,2}[0-9]{2,5}){2,4}(?![0-9])").finditer),
    ("secret", _DIGIT, re.compile(r"(?<![A-Za-z0-9_/+=-])(?=[A-Za-z_/+=-]*[0-9])[A-Za-z0-9_/+=-]{16,}(?![A-Za-z0-9_/+=-])").finditer),
]
_CUES = ["token", "key", "secret", "passw", "tel", "phone", "call", "mobile", "mail", "contact", "ip", "host", "server", "card", "visa",
         "pay", "order", "id", "version", "page", "http", "isbn", "total"]
FEATURES = [*(f"is_{k}" for k in KINDS), "length", "digits", "letters", "uppers", "groups", "longest_group", "spaces", "dots", "dashes",
            "parens", "plus", "at", "equals", "hex", "luhn", "octets", "entropy", "first_digit", "quoted", "after_word", "before_word",
            *(f"cue_{c}" for c in _CUES)]


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Overlapping proposals of all generators, by start, end and kind."""
    return sorted({(m.start(), m.end(), kind) for kind, maybe, find in _GENERATORS if maybe(text) for m in find(text)})


def features(text: str, s: int, e: int, kind: str) -> list[float]:
    span, before, after = text[s:e], text[max(0, s - CONTEXT):s], text[e:e + 2]
    digits = "".join(c for c in span if "0" <= c <= "9")
    groups = re.findall(r"[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    _, n = np.unique(list(span), return_counts=True)
    p = n / n.sum()
    near = before.lower()
    return [*(float(kind == k) for k in KINDS), len(span), len(digits), letters, sum(c.isupper() for c in span), len(groups),
            max(map(len, groups), default=0), span.count(" "), span.count("."), span.count("-"), span.count("(") + span.count(")"),
            float("+" in span), span.count("@"), span.count("="), float(bool(re.fullmatch(r"[0-9a-fA-F]+", span))),
            float(len(digits) > 1 and luhn(digits)), float(len(groups) == 4 and all(len(g) < 4 and int(g) <= 255 for g in groups)),
            round(float(-(p * np.log2(p)).sum()) * 256) / 256, float(digits[:1] or 0), float(before[-1:] in ('"', "'") and bool(before)),
            float(after[:1].isalnum()), float(before[-1:].isalnum()), *(float(c in near) for c in _CUES)]


def _variants(text: str, s: int, e: int, kind: str, turn: int) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): a certain span rewritten as people write it, and spoiled so that it is none."""
    span, before, after = text[s:e], text[max(0, s - CONTEXT):s], text[e:e + 8]
    put = lambda new, label: (before + new + after, len(before), len(before) + len(new), label)
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "email":
        user, _, host = span.partition("@")
        return [put(f"{user} at {host.replace('.', ' dot ')}", 1) if turn % 2 else put(f"{user}[at]{host}", 1),
                put(f"{host.split('.')[0]} at {user[:8] or 'x'}.{host[:3]}", 0)]
    if kind == "ip":
        a, b, c, d = re.findall(r"[0-9]+", span)[:4]
        return [put(f"{int(a) % 9}.{int(b) % 9}.{int(c) % 9}.{int(d) % 99 + 256}", 0), put(f"{a} {b} {c} {d}", 0)]
    if kind == "card":
        bad = digits[:-1] + str((int(digits[-1]) + 1 + turn % 8) % 10)
        return [put(".".join(digits[i:i + 4] for i in range(0, len(digits), 4)), 1), put(bad, 0), put(bad[:13], 0)]
    if kind == "phone":
        return [put(f"00{digits[:1]} {digits[1:4]} {digits[4:7]}-{digits[7:]}", 1), put(f"({digits[1:4]}) {digits[4:7]}-{digits[7:11]}", 1),
                put(f"{digits[:3]} {digits[3:5]} {digits[5:9]}", 0), put(f"{digits[:2]}.{digits[2:4]}.20{digits[4:6]}", 0)]
    return [put("a" * (e - s - 2) + "10", 0), put("-" * (e - s - 1) + "1", 0)]


def training_rows(text: str, turn: int) -> list[tuple[list[float], int, str]]:
    """(features, label, kind) of a text's candidates. Base spans, and key-like
    strings after a cue such as ``token =``, are right; proposals that meet no
    base span and have no cue are wrong; right spans also give rewritten and
    spoiled variants."""
    base = base_spans(text)
    out = []
    for s, e, kind in candidates(text):
        cue = kind == "secret" and re.search(r"(token|key|secret|passw\w*)\W{0,6}$", text[max(0, s - CONTEXT):s].lower()) is not None
        inside = any(s < b and a < e for a, b, _ in base)
        label = int(cue or any((s, e, kind) == (a, b, k) for a, b, k in base))
        if label or not inside:
            out.append((features(text, s, e, kind), label, kind))
        if label:
            for t, a, b, y in _variants(text, s, e, kind, turn):
                out.append((features(t, a, b, kind), y, kind))
    return out


@dataclass
class SpanModel:
    boosted: Boosted
    thresholds: dict[str, float]

    def extra(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Chosen candidates, best first, none overlapping another or a base span."""
        taken = bytearray(len(text))
        for s, e, _ in base:
            taken[s:e] = b"\1" * (e - s)
        free = [c for c in candidates(text) if taken.find(1, c[0], c[1]) < 0]
        if not free:
            return []
        p = self.boosted.predict(np.array([features(text, *c) for c in free]))
        chosen = []
        for i in np.lexsort(([c[0] for c in free], -p)):
            s, e, kind = free[i]
            if p[i] >= self.thresholds[kind] and taken.find(1, s, e) < 0:
                taken[s:e] = b"\1" * (e - s)
                chosen.append(free[i])
        return chosen


CUTS, TREES, DEPTH = 48, 60, 4
_POINT = "codes binary, y int, kind int, held boolean, n bigint"


def _thresholds(kind: np.ndarray, score: np.ndarray, y: np.ndarray, n: np.ndarray) -> dict[str, float]:
    """Of counted scores, for each kind half way between the lowest score down to which precision is at
    least PRECISION and the next one."""
    thresholds = {}
    for i, k in enumerate(KINDS):
        own = kind == i
        s, at = np.unique(-score[own], return_inverse=True)
        right, every = (np.bincount(at, w, len(s)) for w in (n[own] * y[own], n[own]))
        good = np.flatnonzero(np.cumsum(right) >= PRECISION * np.cumsum(every))
        last, below = (-s[good[-1]], -s[good[-1] + 1:][:1].sum()) if len(good) else (2.0, 2.0)
        thresholds[k] = max(MIN_SCORE, float(last + below) / 2) if right.any() else 2.0
    return thresholds


def _scores(model: Boosted, x: np.ndarray) -> np.ndarray:
    """Scores in steps of 1 / 10,000, which bounds what is counted of them."""
    return np.round(model.predict(x), 4)


def _local_sums(codes, y, n, grid):
    """``sums`` for ``boost_counted`` over points at hand."""
    x, state = decoded(codes, grid), {}

    def sums(model, tree, level):
        if not state:
            state.update(z=np.full(len(x), model.start), done=0)
        for t in model.trees[state["done"]:]:
            state["z"] += model.rate * apply_tree(t, x)
        state["done"] = len(model.trees)
        return histogram(codes, x, y, n, state["z"], tree, level, CUTS + 2)

    return sums


def fit_spans(x: np.ndarray, y: np.ndarray, kinds: list[str]) -> SpanModel:
    """Boost on two thirds of the rows at hand and calibrate each kind's threshold on the rest."""
    if not len(y):
        return SpanModel(Boosted(-30.0, 0.0, []), dict.fromkeys(KINDS, 2.0))
    test, one = np.arange(len(y)) % 3 == 2, np.ones(len(y), np.int64)
    grid = [quantile_cuts(x[~test, j], CUTS) for j in range(x.shape[1])]
    model = boost_counted(_local_sums(coded(x[~test], grid), y[~test], one[~test], grid), grid, int((~test).sum()), int(y[~test].sum()), TREES, DEPTH)
    return SpanModel(model, _thresholds(np.array([KINDS.index(k) for k in kinds])[test], _scores(model, x[test]), y[test], one[test]))


def _counted(rows: dict, columns: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], k) for i, k in enumerate(types)), pa.array(list(rows.values()), pa.int64())],
                                      names=[*columns, "n"])


def _matrix(col: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype).reshape(len(col), len(FEATURES))


def _candidate_rows(batches):
    """Counted (x, y, kind, held) of the candidates of a task's texts; a third, by a hash of document and place, is held out."""
    for b in batches:
        found = Counter()
        for key, text in zip(b.column(0).to_pylist(), filled(b.column(1)).to_pylist()):
            for i, (f, y, kind) in enumerate(training_rows(text, key % 97)):
                found[np.array(f, float).tobytes(), y, KINDS.index(kind), (key + i) % 3 == 2] += 1
        if found:
            yield _counted(found, ["x", "y", "kind", "held"], [pa.binary(), pa.int32(), pa.int32(), pa.bool_()])


def _value_rows(batches):
    for b in batches:
        x, n = _matrix(b.column("x"), float), b.column("n").to_numpy()
        for j in range(x.shape[1]):
            v, at = np.unique(x[:, j], return_inverse=True)
            yield pa.RecordBatch.from_pydict({"feature": pa.array(np.full(len(v), j), pa.int32()), "v": v,
                                              "n": pa.array(np.bincount(at, n, len(v)).astype(np.int64))})


def _spark_sums(points: DataFrame, grid):
    """``sums`` for ``boost_counted`` over a table of points: one pass a level of a tree. A task sends sums by
    node, feature and code, and Spark adds them up."""
    spark, width = points.sparkSession, CUTS + 2

    def sums(model, tree, level):
        shared = spark.sparkContext.broadcast((model, tree, grid))

        def run(batches):
            total, (model, tree, grid) = 0, shared.value
            for b in batches:
                codes = _matrix(b.column("codes"), np.uint8)
                x = decoded(codes, grid)
                total = total + histogram(codes, x, b.column("y").to_numpy(), b.column("n").to_numpy(), model.raw(x), tree, level, width)
            if not isinstance(total, int):
                at = np.flatnonzero(total[2])
                yield pa.RecordBatch.from_pydict({"cell": at, **{c: total[i].ravel()[at] for i, c in enumerate("ghn")}})

        got = points.select("codes", "y", "n").mapInArrow(run, "cell bigint, g bigint, h bigint, n bigint") \
            .groupBy("cell").agg(*[F.sum(c).alias(c) for c in "ghn"]).toArrow()
        out = np.zeros((3, len(frontier(tree, level)) * len(FEATURES) * width), np.int64)
        for i, c in enumerate("ghn"):
            out[i, got["cell"].to_numpy()] = got[c].to_numpy()
        shared.destroy()
        return out.reshape(3, -1, len(FEATURES), width)

    return sums


def train_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", driver_points: int = DRIVER_POINTS, trees: int = TREES) -> SpanModel:
    """Fit on all candidates of all documents: boost on two thirds of them and calibrate each kind's threshold
    on the rest.

    Equal candidates are counted. Quantile cuts come from the counts of every feature's distinct values
    (numbers of characters, mostly; entropies in steps of 1 / 256), and points are the codes between
    cuts. Up to ``driver_points`` different points the driver grows the trees; of more, Spark sums the
    histograms, a pass a level, to the same trees. Thresholds come from counted scores.
    """
    base = docs.select(F.xxhash64(F.col(id_col)).alias("__key"), F.col(text_col).cast("string").alias("text"))
    cells = materialise(base.where(F.col("text").rlike("[0-9@]")).mapInArrow(_candidate_rows, "x binary, y int, kind int, held boolean, n bigint"))
    counts = cells.where("NOT held").select("x", "n").mapInArrow(_value_rows, "feature int, v double, n bigint") \
        .groupBy("feature", "v").agg(F.sum("n").alias("n")).orderBy("feature", "v").toArrow()
    if not len(counts):
        return fit_spans(np.empty((0, len(FEATURES))), np.empty(0), [])
    feature, v, n = (counts[c].to_numpy() for c in ("feature", "v", "n"))
    grid = [counted_cuts(v[feature == j], n[feature == j], CUTS) for j in range(len(FEATURES))]

    def codes(batches):
        for b in batches:
            found = Counter()
            for c, y, kind, held, m in zip(coded(_matrix(b.column("x"), float), grid), *(b.column(k).to_pylist() for k in ("y", "kind", "held", "n"))):
                found[c.tobytes(), y, kind, held] += m
            yield _counted(found, ["codes", "y", "kind", "held"], [pa.binary(), pa.int32(), pa.int32(), pa.bool_()])

    point = ["codes", "y", "kind", "held"]
    points = materialise(cells.mapInArrow(codes, _POINT).groupBy(*point).agg(F.sum("n").alias("n")))
    fit = points.where("NOT held")
    total = fit.agg(F.count("*").alias("points"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("positive")).first()
    if total.points <= driver_points:  # measured
        got = fit.select("codes", "y", "n").toArrow()
        sums = _local_sums(_matrix(got["codes"], np.uint8), got["y"].to_numpy(), got["n"].to_numpy(), grid)
    else:
        sums = _spark_sums(fit, grid)
    model = boost_counted(sums, grid, total.n, total.positive, trees, DEPTH)

    def scored(batches):
        for b in batches:
            found = Counter()
            p = _scores(model, decoded(_matrix(b.column("codes"), np.uint8), grid))
            for k, s, y, m in zip(b.column("kind").to_pylist(), p.tolist(), b.column("y").to_pylist(), b.column("n").to_pylist()):
                found[k, s, y] += m
            yield _counted(found, ["kind", "s", "y"], [pa.int32(), pa.float64(), pa.int32()])

    held = points.where("held").mapInArrow(scored, "kind int, s double, y int, n bigint").groupBy("kind", "s", "y").agg(F.sum("n").alias("n")).toArrow()
    return SpanModel(model, _thresholds(*(held[c].to_numpy() for c in ("kind", "s", "y", "n"))))


def _all_spans(text: str, model: SpanModel) -> tuple[list, list]:
    base = base_spans(text)
    return base, sorted(base + model.extra(text, base), key=lambda s: (s[0], KINDS.index(s[2])))


def _join(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: SpanModel | None = None) -> DataFrame:
    """One row per input row: doc_id, the number of base spans of each kind,
    base_sha256 over them, spans (base and chosen spans as kind:start:end in code
    points, by start, then kind), n_added (chosen beyond the base).

    NULL and empty texts have no spans; NULL ids and repeated rows keep their
    rows; other columns are not read; an empty table gives no rows. Work is
    linear in the text's length; documents are not shuffled.
    """
    fitted = docs.sparkSession.sparkContext.broadcast(model or train_spans(docs, id_col=id_col, text_col=text_col))

    def run(batches):
        for b in batches:
            got = [_all_spans(t, fitted.value) for t in filled(b.column(1)).to_pylist()]
            count = {k: pa.array([sum(s[2] == k for s in base) for base, _ in got], pa.int64()) for k in KINDS[:4]}
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), **{f"n_{k}": v for k, v in count.items()},
                "base_sha256": pa.array([hashlib.sha256(_join(base).encode()).hexdigest() for base, _ in got], pa.string()),
                "spans": pa.array([_join(every) for _, every in got], pa.string()),
                "n_added": pa.array([len(every) - len(base) for base, every in got], pa.int64())})

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span, merged where they overlap, replaced by its kind in brackets."""
    out, done = [], 0
    for s, e, kind in spans:
        if s >= done:
            out += [text[done:s], f"[{kind.upper()}]"]
        done = max(done, e)
    return "".join(out) + text[done:]


def redact_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
               model: SpanModel | None = None) -> DataFrame:
    """``docs``, all columns and rows, with personal data in the text replaced
    and ``chars_col`` (where there is one) set to the new length of changed rows.
    A NULL text stays NULL."""
    fitted = docs.sparkSession.sparkContext.broadcast(model or train_spans(docs, id_col=id_col, text_col=text_col))
    at, schema = docs.columns.index(text_col), docs.schema
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else -1

    def run(batches):
        for b in batches:
            texts, n = b.column(at).to_pylist(), b.column(chars).to_pylist() if chars >= 0 else []
            for i, t in enumerate(texts):
                spans = _all_spans(t, fitted.value)[1] if t else []
                if spans:
                    texts[i] = redact(t, spans)
                    if chars >= 0:
                        n[i] = len(texts[i])
            cols = list(b.columns)
            cols[at] = pa.array(texts, b.schema.field(at).type)
            if chars >= 0:
                cols[chars] = pa.array(n, b.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, schema)
