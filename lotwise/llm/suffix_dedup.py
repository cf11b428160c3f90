"""Suffix-array dedup of repeated byte strings by prefix-free parsing.

A byte is removed when a ``LENGTH``-byte string covers it that also starts in a
document with a smaller id. The steps:

1. Each task parses its texts into phrases by rolling-hash triggers
   (``parsing.phrases``): every LENGTH-byte string lies in one phrase, and equal
   strings have the same trigger. A phrase that an earlier document of the task
   holds too is settled at once; the rest of the parse, (trigger, phrase,
   document, place), goes to the bucket of its trigger.
2. A bucket sorts its share of dictionary and parse. Equal phrases leave their
   smallest document; in all others every string of the phrase is repeated.
   Different phrases with one trigger may still share strings, so the bytes of
   each are asked for, from one place.
3. The tasks that hold the texts send the asked phrases to the bucket of their
   trigger. There the suffix array of this part of the dictionary is built over
   suffixes of at least LENGTH bytes; neighbours with a common prefix of LENGTH
   bytes form a run, ordered by the documents of the parse: all but the smallest
   document repeat the string.
4. The settled places return to their texts, which are cut.

Records travel as packed blobs (``blobs``); texts are compressed and dealt once,
for steps 3 and 4 alike. Phrases of a trigger that is crowded (more than
``CROWD`` phrases in a flush of a task or ``CROWD_ALL`` in its bucket) are not
gathered: their suffix runs are built where their texts are and only run heads
travel, to the bucket of the string's hash, so a passage that a third of all
documents share is no hot bucket. A flush that finds a trigger crowded marks what
it sends of it; the bucket then has the phrases of all other flushes turned into
runs too, so that all strings of the trigger meet in one form.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blobs import BUCKETS_PER_PARTITION, bucket_count, deal, pack, runs, unpack
from .parsing import GRAM, LENGTH, phrases
from .tables import materialise
from .text import byte_view, filled, mix64, pieces, prefix_sums, substring_hash

#: Text that a task parses before it settles and sends what it found, phrases of one
#: trigger it sends from it, and phrases of one trigger that a bucket gathers.
FLUSH_BYTES, CROWD, CROWD_ALL = 1 << 24, 64, 2048
#: Records that a task holds before it sends them.
HELD = 1 << 20
#: What a task knows about a group of texts is one row: its ranges (payload), what it
#: asks for and the places of phrases that one document holds more than once.
ROW = "key int, kind int, payload binary, ask binary, more binary"
RANGE, PARSE, PHRASE, RUN = range(4)
_RANGE = [8, 7, 7]          # document, first start, last start
_ASK = [3, 8, 7, 1]         # bucket of the trigger (_AS_RUNS: crowded), document, first start, starts - 1
_AS_RUNS = (1 << 24) - 1
_MORE = [6, 8, 7, 1]        # phrase, document, first start, starts - 1, for phrases that one document (one block of it) holds more than once
_PHRASE = [8, 7, 1]         # document, first start, starts - 1; the bytes follow
_PARSE = [5, 6, 8, 7, 1, 1]  # trigger, phrase, document, first start, starts - 1, whether its strings went as runs
_RUN = [6, 5, 8, 7]         # two hashes of LENGTH bytes, document, start
SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
_LAST = np.iinfo(np.int64).max  # stands for a NULL id
#: The rows of one id are dealt over blocks: a place is block << BLOCK_BITS plus a place in
#: the block. A block has about BLOCK_BYTES of an id's text, a group about GROUP_BYTES of all.
BLOCK_BITS, BLOCK_BYTES, MOST_BLOCKS, GROUP_BYTES = 36, 1 << 24, 1 << 18, 1 << 25
#: Copies of one row that one array stands for when they are written out again.
COPIES = 1 << 16


def _rows(found: list[tuple]) -> pa.RecordBatch:
    """Rows of (key, kind, payload[, ask, more])."""
    columns = list(zip(*[f + (None,) * (5 - len(f)) for f in found])) or [()] * 5
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "kind", "payload", "ask", "more"])


def _group(doc: np.ndarray, place: np.ndarray, groups: int) -> np.ndarray:
    """The group of the text of document ``doc`` that holds ``place``."""
    block = (place.astype(np.int64) >> BLOCK_BITS).view(np.uint64)
    return (mix64(doc.astype(np.int64).view(np.uint64) + block * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(groups)).astype(np.int64)


def _ranges(doc, a, b, groups: int) -> list[tuple[int, int, bytes]]:
    """Rows for removed strings, given by their starts a..b; neighbouring ranges are joined first."""
    if not len(doc):
        return []
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (a[1:] > b[:-1] + 1)])
    doc, a, b = doc[first], a[first], np.maximum.reduceat(b, first)
    return [(k, RANGE, p) for k, p in deal(_group(doc, a, groups), [doc, a, b], _RANGE)]


def _settle_runs(data: np.ndarray, at: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int, groups: int) -> list[tuple[int, int, bytes]]:
    """Strings of crowded phrases: those that an earlier document here holds too
    become ranges, the others run records."""
    if not len(at):
        return []
    order, late = _suffix_runs(data, at, doc, length)
    doc, start, at = doc[order], start[order], at[order]
    out = _ranges(doc[late], start[late], start[late], groups)
    p = prefix_sums(data)
    w = substring_hash(p, at[~late], at[~late] + length)
    w2 = mix64(substring_hash(p, at[~late] + 1, at[~late] + length - 1) + np.uint64(7))
    out += [(k, RUN, b) for k, b in deal(((w >> np.uint64(48)) % np.uint64(groups)).astype(np.int64), [w, w2, doc[~late], start[~late]], _RUN)]
    return out


def _suffix_runs(data: np.ndarray, at: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of ``data`` over the suffixes at ``at`` (by their first
    ``length`` bytes, then document), and which of them stand in a run behind a
    smaller document."""
    view = np.empty((len(at), length + 1), np.uint8)
    view[:, :length] = np.lib.stride_tricks.sliding_window_view(data, length)[at]
    view[:, length] = 1  # NumPy drops trailing zero bytes of fixed strings
    suffix = view.view(f"S{length + 1}").ravel()
    order = np.argsort(suffix, kind="stable")
    order = order[np.lexsort((doc[order], np.cumsum(np.r_[True, suffix[order][1:] != suffix[order][:-1]])))]
    own = suffix[order]
    head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    least = np.repeat(doc[order][head], np.diff(np.r_[head, len(order)]))
    return order, doc[order] != least


def _strings(text: np.ndarray, pos: np.ndarray, span: np.ndarray, length: int):
    """(bytes of the phrases, place of each string in them, phrase of each string, string's number in it)."""
    n = span + length
    end = np.cumsum(n)
    data = text[np.repeat(pos - (end - n), n) + np.arange(end[-1] if len(n) else 0)]
    of = np.repeat(np.arange(len(n)), span + 1)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(span + 1) - (span + 1), span + 1)
    return data, (end - n)[of] + nth, of, nth


def _parse(groups: int, length: int, gram: int, crowd: int):
    """Step 1 over batches (doc_id, base, text)."""
    def settle(found, texts):
        trig, phr, doc, a, span, pos = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((a, doc, phr, trig))
        trig, phr, doc, a, span, pos = (x[order] for x in (trig, phr, doc, a, span, pos))
        head = runs(trig, phr)
        size = np.diff(np.r_[head, len(trig)])
        late = doc != np.repeat(doc[head], size)
        out = _ranges(doc[late], a[late], a[late] + span[late], groups)
        of = runs(trig[head])
        many = np.diff(np.r_[of, len(head)])
        nth = np.arange(len(head)) - np.repeat(of, many)
        crowded = np.repeat(np.repeat(many > crowd, many), size)
        if crowded.any():
            own = np.flatnonzero(crowded & ~late)
            data, at, rec, n = _strings(np.concatenate(texts), pos[own], span[own], length)
            out += _settle_runs(data, at, doc[own][rec], a[own][rec] + n, length, groups)
        send = ~late & (~crowded | np.repeat(nth < 2, size))  # two phrases tell the bucket that the trigger is shared
        bucket = ((trig[send] >> np.uint64(40)) % np.uint64(groups)).astype(np.int64)
        out += [(k, PARSE, p) for k, p in deal(bucket, [trig[send], phr[send], doc[send], a[send], span[send], crowded[send].astype(np.int64)], _PARSE)]
        return _rows(out)

    def run(batches):
        found, texts, size = [], [], 0
        for b in batches:
            ids = b.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False)
            base, col = b.column(1).to_numpy(zero_copy_only=False), filled(b.column(2))
            for lo, part in pieces(col):
                buf, offs = byte_view(part)
                trig, phr, row, first, last = phrases(buf, offs, length, gram)
                if len(trig):
                    found.append((trig, phr, ids[lo + row], base[lo + row] + first, last - first, size + offs[row] + first))
                    texts.append(buf)
                    size += len(buf)
                if size >= FLUSH_BYTES:
                    yield settle(found, texts)
                    found, texts, size = [], [], 0
        if found:
            yield settle(found, texts)
    return run


def _keyed(batches, kinds: tuple[int, ...]):
    """((key, kind), payloads) in sorted order; rows of other kinds come as (None, batch)."""
    last, held = None, []
    for b in batches:
        kind = b.column(1).to_numpy(zero_copy_only=False)
        own = np.isin(kind, kinds)
        if not own.all():
            yield None, b.filter(pa.array(~own))
        keys = b.column(0).to_numpy(zero_copy_only=False)[own].tolist()
        for k, payload in zip(zip(keys, kind[own].tolist()), b.column(2).filter(pa.array(own)).to_pylist()):
            if k != last and held:
                yield last, held
                held = []
            last = k
            held.append(payload)
    if held:
        yield last, held


class _Held:
    """Records of several buckets, dealt together so that few blobs leave a task."""

    def __init__(self):
        self.lists: dict[str, list] = {}
        self.size = 0

    def add(self, name: str, *arrays: np.ndarray) -> None:
        self.lists.setdefault(name, []).append(arrays)
        self.size += len(arrays[0])

    def take(self, name: str) -> list[np.ndarray] | None:
        got = self.lists.pop(name, None)
        return [np.concatenate(x) for x in zip(*got)] if got else None


def _records(payloads: list[bytes], widths: list[int]) -> list[np.ndarray]:
    parts = [unpack(p, widths) for p in payloads]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64) for _ in widths]


def _settle_phrases(groups: int, crowd_all: int):
    """Step 2: buckets of parse records; other rows pass."""
    def send(held: _Held) -> pa.RecordBatch:
        told: dict[int, list] = {}
        if r := held.take("range"):
            for k, _, p in _ranges(*r, groups):
                told.setdefault(k, [None] * 3)[0] = p
        for i, (name, widths) in enumerate((("ask", _ASK), ("more", _MORE)), 1):
            if r := held.take(name):
                for k, p in deal(_group(r[1], r[2], groups), r, widths):
                    told.setdefault(k, [None] * 3)[i] = p
        return _rows([(k, RANGE, *t) for k, t in told.items()])

    def run(batches):
        held = _Held()
        for key, own in _keyed(batches, (PARSE,)):
            if key is None:
                yield own
                continue
            trig, phr, doc, a, span, sent = _records(own, _PARSE)
            order = np.lexsort((a, doc, phr, trig))
            trig, phr, doc, a, span, sent = (x[order] for x in (trig, phr, doc, a, span, sent))
            head = runs(trig, phr)
            size = np.diff(np.r_[head, len(trig)])
            late = doc != np.repeat(doc[head], size)
            of = runs(trig[head])
            phrases_of = np.diff(np.r_[of, len(head)])
            many = np.repeat(phrases_of > 1, phrases_of)
            held.add("range", doc[late], a[late], a[late] + span[late])
            marked = np.maximum.reduceat(sent, head[of]) > 0
            as_runs = np.repeat(np.repeat(marked | (phrases_of > crowd_all), phrases_of), size)
            at = runs(trig, phr, doc, a >> BLOCK_BITS)  # each block of a phrase's smallest document is asked
            copies = np.repeat(np.diff(np.r_[at, len(trig)]), np.diff(np.r_[at, len(trig)]))
            own = ~late & np.repeat(many, size)
            first = at[own[at] & (sent[at] == 0)]  # strings of a marked flush are runs already
            held.add("ask", np.where(as_runs[first], _AS_RUNS, key[0]), doc[first], a[first], span[first])
            more = own & (copies > 1)
            held.add("more", phr[more], doc[more], a[more], span[more])
            if held.size > HELD:
                yield send(held)
                held = _Held()
        yield send(held)
    return run


def _settle_strings(groups: int, length: int):
    """Step 3, second half: the suffix array of the phrases of a bucket, and the
    bucket's run heads of crowded phrases. All but the smallest document of a run
    are repeated."""
    def run(batches):
        held = _Held()
        for key, own in _keyed(batches, (PHRASE, RUN)):
            if key is None:
                yield own
                continue
            if key[1] == PHRASE:
                doc, a, span, data = _unpack_phrases(own)
                _, at, rec, n = _strings(data, np.cumsum(span + length) - (span + length), span, length)
                doc, start = doc[rec], a[rec] + n
                order, late = _suffix_runs(data, at, doc, length)
                doc, start = doc[order], start[order]
            else:
                w, w2, doc, start = _records(own, _RUN)
                order = np.lexsort((doc, w2, w))
                w, w2, doc, start = (x[order] for x in (w, w2, doc, start))
                head = runs(w, w2)
                late = doc != np.repeat(doc[head], np.diff(np.r_[head, len(doc)]))
            held.add("range", doc[late], start[late], start[late])
            if held.size > HELD:
                yield _rows(_ranges(*held.take("range"), groups))
                held = _Held()
        if r := held.take("range"):
            yield _rows(_ranges(*r, groups))
    return run


def _pack_phrases(doc, a, span, data: np.ndarray) -> bytes:
    head = pack([doc, a, span], _PHRASE)
    return len(head).to_bytes(4, "little") + head + zstandard.ZstdCompressor(level=3).compress(data.tobytes())


def _unpack_phrases(payloads: list[bytes]):
    heads, data = [], []
    for p in payloads:
        n = int.from_bytes(p[:4], "little")
        heads.append(unpack(p[4:4 + n], _PHRASE))
        data.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(p[4 + n:]), np.uint8))
    return *(np.concatenate(x) for x in zip(*heads)), np.concatenate(data)


def _texts(table: pa.Table):
    """(doc_id, base, bytes, copies) of each text row of a group."""
    unzip = zstandard.ZstdDecompressor()
    for d, base, n, z in zip(*(table[c].to_pylist() for c in ("doc_id", "base", "copies", "payload"))):
        yield d, base, np.frombuffer(unzip.decompress(z), np.uint8), n


def _of(doc: np.ndarray, a: np.ndarray, key: int, base: int, n: int) -> slice:
    """Records (sorted by document and place) that lie in one text."""
    lo, hi = np.searchsorted(doc, key, "left"), np.searchsorted(doc, key, "right")
    return slice(lo + int(np.searchsorted(a[lo:hi], base)), lo + int(np.searchsorted(a[lo:hi], base + n)))


def _key_or_last(doc_id) -> int:
    return int(_LAST) if doc_id is None else doc_id


def _phrases(groups: int, length: int):
    """Step 3, first half: a group's texts and what was asked of them. The bytes of
    asked phrases go to the bucket of their trigger, crowded ones become runs here."""
    def run(texts: pa.Table, asked: pa.Table) -> pa.Table:
        to, doc, a, span = _records(asked["ask"].to_pylist(), _ASK)
        order = np.lexsort((a, doc))
        to, doc, a, span = (x[order] for x in (to, doc, a, span))
        found = []
        for d, base, buf, _ in _texts(texts) if len(doc) else ():
            own = _of(doc, a, _key_or_last(d), base, len(buf))
            if own.stop > own.start:
                data, *_ = _strings(buf, a[own] - base, span[own], length)
                found.append((to[own], doc[own], a[own], span[own], data))
        if not found:
            return pa.Table.from_batches([_rows([])])
        to, doc, a, span, data = (np.concatenate(x) for x in zip(*found))
        begin = np.cumsum(span + length) - (span + length)
        out = []
        order = np.argsort(to, kind="stable")
        first = runs(to[order])
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(order)]):
            own = order[lo:hi]
            part, at, rec, n = _strings(data, begin[own], span[own], length)
            if to[own[0]] == _AS_RUNS:
                out += _settle_runs(part, at, doc[own][rec], a[own][rec] + n, length, groups)
            else:
                out.append((int(to[own[0]]), PHRASE, _pack_phrases(doc[own], a[own], span[own], part)))
        return pa.Table.from_batches([_rows(out)])
    return run


def _cut(length: int):
    """Step 4: a group's texts, the settled ranges, and the places of phrases that
    one document holds more than once (they follow the first place)."""
    def run(texts: pa.Table, settled: pa.Table) -> pa.Table:
        doc, a, b = _records([p for p in settled["payload"].to_pylist() if p], _RANGE)
        order = np.lexsort((a, doc))
        doc, a, b = doc[order], a[order], b[order]
        phr, mdoc, place, span = _records([p for p in settled["more"].to_pylist() if p], _MORE)
        order = np.lexsort((place, phr, mdoc))
        phr, mdoc, place, span = phr[order], mdoc[order], place[order], span[order]
        head = runs(mdoc, phr)
        first = np.repeat(place[head], np.diff(np.r_[head, len(phr)]))

        def repeated(lo: int, hi: int, f: int, n: int) -> np.ndarray:
            """Which of the starts f..f + n the ranges lo..hi of a document hold."""
            own = slice(lo, lo + int(np.searchsorted(a[lo:hi], f + n, "right")))
            edge = np.zeros(n + 2, np.int32)
            live = b[own] >= f
            np.add.at(edge, np.maximum(a[own][live] - f, 0), 1)
            np.add.at(edge, np.minimum(b[own][live] - f, n) + 1, -1)
            return np.cumsum(edge[:n + 1]) > 0

        rows = []
        for d, base, buf, copies in _texts(texts):
            key, n = _key_or_last(d), len(buf)
            lo, hi = int(np.searchsorted(doc, key, "left")), int(np.searchsorted(doc, key, "right"))
            if lo == hi:
                rows.append((d, n, 0, 0, hashlib.sha256(buf).hexdigest(), copies))
                continue
            starts = repeated(lo, hi, base, n)[:n]
            mlo, mhi = np.searchsorted(mdoc, key, "left"), np.searchsorted(mdoc, key, "right")
            known: dict[int, np.ndarray] = {}
            for f, p, s in zip(first[mlo:mhi].tolist(), place[mlo:mhi].tolist(), span[mlo:mhi].tolist()):
                if p != f and base <= p < base + n:
                    if f not in known:
                        known[f] = repeated(lo, hi, f, s)
                    starts[p - base:p - base + s + 1] |= known[f]
            count = np.cumsum(np.r_[0, starts])
            i = np.arange(1, n + 1)
            gone = count[i] > count[np.maximum(i - length, 0)]
            spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            rows.append((d, n, int(gone.sum()), spans, hashlib.sha256(buf[~gone].tobytes()).hexdigest(), copies))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "copies"]
        types = [pa.int64()] * 4 + [pa.string(), pa.int64()]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
    return run


def _text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _with_base(docs: DataFrame, size: int, block_bytes: int) -> DataFrame:
    """(doc_id, base, copies, text): equal rows are one row with their number.
    Other texts that share an id are one document; each lies in a block that its
    hash names, behind the others there, and base is where its places begin. So
    an id that a third of all rows share is many groups."""
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return docs.select("doc_id", F.lit(0).cast("bigint").alias("base"), F.lit(1).cast("bigint").alias("copies"), "text")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.sha2(text, 256).alias("__h"), text.alias("text")).groupBy("doc_id", "__h").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    blocks = min(MOST_BLOCKS, 1 + size // block_bytes)
    before = Window.partitionBy("doc_id", "__block").orderBy("__h").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__block", F.pmod(F.xxhash64("__h"), F.lit(blocks)))
    base = F.shiftleft(F.col("__block"), BLOCK_BITS) + F.coalesce(F.sum(F.octet_length("text").cast("bigint") + 1).over(before), F.lit(0))
    return materialise(rows.select("doc_id", base.cast("bigint").alias("base"), "copies", "text"))


def _each_copy(rows: DataFrame) -> DataFrame:
    """A row as often as ``copies`` says."""
    some = rows.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES}"))))
    return some.withColumn("__one", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col("copies") - F.col("__part") * COPIES).cast("int")))) \
        .drop("copies", "__part", "__one")


def _dealt(rows: DataFrame, parts: int):
    """``rows`` by key, over more partitions than usual where there are more groups."""
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "key") if parts > usual else rows).groupBy("key")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, crowd_all: int = CROWD_ALL,
                   block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 (of the remaining UTF-8 bytes).

    A byte goes when a ``length``-byte string of its text covers it that also
    starts in a document with a smaller id; strings never cross documents and are
    judged on the input. NULL and empty texts have no bytes; a NULL id is larger
    than any other; rows that share an id are one document to each other (nothing
    goes because of them); other columns are not read; an empty table gives no
    rows. Hashes that stand for strings have 80 bits or more together. The number of
    groups follows the bytes of all texts, and an id's rows are dealt over blocks.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = _text_bytes(slim)
    groups = max(bucket_count(docs.sparkSession), -(-size // GROUP_BYTES))
    parts = -(-groups // BUCKETS_PER_PARTITION)
    base = _with_base(slim, size, block_bytes)

    def settle(rows, step):
        return rows.repartitionById(parts, F.col("key")).sortWithinPartitions("key", "kind").mapInArrow(step, ROW)

    def zipped(batches):
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            ids, at = b.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_group(ids, at, groups).astype(np.int32)), b.column(0), b.column(1), b.column(2),
                 pa.array([z.compress(t or b"") for t in b.column(3).to_pylist()], pa.binary())], names=["key", "doc_id", "base", "copies", "payload"])

    parsed = base.select("doc_id", "base", "text").mapInArrow(_parse(groups, length, gram, crowd), ROW)
    first = materialise(settle(parsed, _settle_phrases(groups, crowd_all)))
    texts = base.select("doc_id", "base", "copies", F.col("text").cast("binary")) \
        .mapInArrow(zipped, "key int, doc_id bigint, base bigint, copies bigint, payload binary")
    asked = first.where("ask IS NOT NULL").select("key", "ask")
    strings = _dealt(texts, parts).cogroup(_dealt(asked, parts)).applyInArrow(_phrases(groups, length), ROW)
    second = settle(strings.unionAll(first.where(F.col("kind") == RUN)), _settle_strings(groups, length))
    settled = first.where((F.col("kind") == RANGE) & (F.col("payload").isNotNull() | F.col("more").isNotNull())).select("key", "payload", "more") \
        .unionAll(second.select("key", "payload", "more"))
    return _each_copy(_dealt(texts, parts).cogroup(_dealt(settled, parts)).applyInArrow(_cut(length), SCHEMA + ", copies bigint"))
