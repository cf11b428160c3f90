"""Target-distribution importance resampling over hashed word n-grams.

Texts of a batch are joined into one buffer with sentinel bytes between them
(0xFF, which no UTF-8 text holds). One regular-expression pass finds every word
of the batch; the document of a word is its place among the document offsets
(searchsorted), so runs of words that would cross a sentinel are masked before
the hashed features are counted with bincount.

A bucket's gain is the log ratio of its smoothed shares in the target table and
in the corpus; a document's weight is the sum of its features' gains, and adding
Gumbel noise drawn from its id turns the highest scores into a weighted sample
without replacement.
"""
from __future__ import annotations

import hashlib
import math
import re
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise
from .text import byte_view, filled, pieces

BUCKETS, MAX_N, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, "2024"
_WORD = re.compile(rb"[0-9a-z\x80-\xfe]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def batch_features(col: pa.Array, max_n: int = MAX_N, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every run of 1 to ``max_n`` words of texts without NULLs,
    and the number of words of each row."""
    buf, offs = byte_view(col)
    data = buf.tobytes()
    joined = b"\xff".join([data[a:b] for a, b in pairwise(offs.tolist())]).translate(_LOWER)
    starts, found = [], []
    for m in _WORD.finditer(joined):
        starts.append(m.start())
        found.append(m.group())
    at = np.array(starts, np.int64)
    begins = offs[:-1] + np.arange(len(col))
    row = np.searchsorted(begins, at, side="right") - 1
    crc = list(map(zlib.crc32, found))
    out, rows = [np.array(crc, np.int64)], [row]
    for n in range(2, max_n + 1):
        crc = [zlib.crc32(b" " + w, c) for c, w in zip(crc, found[n - 1:])]
        whole = row[:len(crc)] == row[n - 1:]
        out.append(np.array(crc, np.int64)[whole])
        rows.append(row[:len(crc)][whole])
    return np.concatenate(out) % buckets, np.concatenate(rows), np.bincount(row, minlength=len(col))


def bucket_counts(texts: DataFrame, text_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket. Each task counts into one array of
    ``buckets`` numbers; at most ``buckets`` sums reach the driver."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, part in pieces(filled(b.column(0))):
                total += np.bincount(batch_features(part, max_n, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    out = np.zeros(buckets, np.int64)
    for r in texts.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket int, n bigint") \
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of add-one shares, bucket by bucket."""
    s, t, k = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + k) / ((a + 1.0) * (t + k))))
                     for a, b in zip(source.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int | None, seed: str = SEED) -> int:
    """floor(1000 g) of a Gumbel draw fixed by the id; a NULL id draws as the empty text."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_n: int = MAX_N,
                    seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def score(batches):
        gain = shared.value
        for b in batches:
            ids, texts = b.column(0).to_pylist(), filled(b.column(1))
            n_words, n_features, weight = (np.zeros(len(ids), np.int64) for _ in range(3))
            for lo, part in pieces(texts):
                bucket, row, count = batch_features(part, max_n, len(gain))
                own = slice(lo, lo + len(part))
                n_words[own] = count
                n_features[own] = np.bincount(row, minlength=len(part))
                weight[own] = np.bincount(row, gain[bucket].astype(float), len(part)).astype(np.int64)  # whole numbers far below 2^53
            noise = np.array([gumbel(i, seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_words": pa.array(n_words), "n_features": pa.array(n_features),
                                              "weight": pa.array(weight), "score": pa.array(weight + noise)})

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(score, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def rank_highest(scored: DataFrame, n_drawn: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): ranks 1 to ``n_drawn`` by
    falling score, ties to the smaller id, other ranks NULL.

    Equal rows are counted first. Scores fall into ranges of about equal size; a
    row's rank is its running place in its range plus the sizes of the ranges
    above, so no task orders more than one range. Only range borders and sizes
    reach the driver, a number fixed by the partition count."""
    spark = scored.sparkSession
    cols = ["doc_id", "n_words", "n_features", "weight", "score"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = scored.agg(F.percentile_approx("score", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else None
    cuts = sorted(set(cuts or []))
    place = F.lit(len(cuts)) - F.size(F.filter(F.array(*[F.lit(int(c)).cast("bigint") for c in cuts]), lambda c: c < F.col("score"))) \
        if cuts else F.lit(0)
    counted = scored.groupBy(*cols).agg(F.count("*").alias("copies")).withColumn("range", place)
    size = {r.range: r.n for r in counted.groupBy("range").agg(F.sum("copies").alias("n")).collect()}
    above = dict(zip(range(len(cuts) + 1), np.r_[0, np.cumsum([size.get(i, 0) for i in range(len(cuts))])].tolist()))
    before = F.element_at(F.array(*[F.lit(int(above[i])).cast("bigint") for i in range(len(cuts) + 1)]), F.col("range") + 1)
    order = Window.partitionBy("range").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "weight", "n_features", "n_words") \
        .rowsBetween(Window.unboundedPreceding, 0)
    upto = before + F.sum("copies").over(order)
    return counted.withColumn("upto", upto) \
        .select(*cols, F.explode(F.sequence(F.col("upto") - F.col("copies") + 1, F.col("upto"))).alias("rank")) \
        .withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             max_n: int = MAX_N, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT,
             seed: str = SEED) -> DataFrame:
    """Every document's features, weight, score and, if drawn, rank: the
    floor(percent * N / 100) highest scores of the N documents with at least
    ``least_words`` words.

    Only A-Z are lower-cased; words are runs of letters, digits and characters
    beyond ASCII. A NULL or empty text has no features and weight 0; a NULL id
    draws its noise as the empty text and stands behind equal scores; rows that
    repeat are drawn one by one; an empty corpus gives an empty result, and with
    an empty target gains come from the corpus alone. Other columns are not
    read. Statistics cover all texts of both tables.
    """
    gain = gains(bucket_counts(docs, text_col, max_n, buckets), bucket_counts(target, target_col, max_n, buckets))
    scored = materialise(score_documents(docs, gain, id_col, text_col, max_n, seed))
    able = scored.where(F.col("n_words") >= least_words)
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return rank_highest(able, able.count() * percent // 100).unionByName(rest)


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: DuckDB twin for unigrams; crc32 is written out as list folds over the distinct words.
RESAMPLE_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS MATERIALIZED (SELECT {_WORDS} AS ws FROM benchmark),
crc AS (SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
        FROM (SELECT unnest(range(256)) AS i)),
u AS (SELECT DISTINCT unnest(ws) AS w FROM (SELECT ws FROM d UNION ALL SELECT ws FROM b)),
v AS MATERIALIZED (SELECT w, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(w))),
        lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS k
      FROM u, crc),
f AS MATERIALIZED (SELECT doc_id, k, n FROM (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM d) GROUP BY ALL) JOIN v USING (w)),
s AS (SELECT k, sum(n)::BIGINT AS s FROM f GROUP BY k),
t AS (SELECT k, count(*) AS t FROM (SELECT unnest(ws) AS w FROM b) JOIN v USING (w) GROUP BY k),
tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000 AS sa, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + 10000 AS ta),
g AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * sa / ((coalesce(s, 0) + 1)::DOUBLE * ta)))::BIGINT AS g
      FROM s FULL JOIN t USING (k), tot),
w AS (SELECT doc_id, sum(n * g)::BIGINT AS weight, sum(n)::BIGINT AS n_features FROM f JOIN g USING (k) GROUP BY doc_id),
z AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN w USING (doc_id)),
c AS MATERIALIZED (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM z),
r AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM c)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM c WHERE n_features >= 20) THEN place END AS rank FROM r"""
