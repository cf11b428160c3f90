"""URL filters: host and path rules, then logistic regression on hashed character n-grams.

The model is trained on a small labelled URL table and compiled into one Spark
column expression (a folded array of weights summed over the hashed n-grams of
a URL), so judging URLs is a scan without Python or a shuffle.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS, GRAMS = 4096, (3, 4, 5)
Rule = tuple[str, str, str]  # verdict, host, path

#: Words of the built-in labelled table: general names of unwanted and of ordinary sites, none taken
#: from the pages it judges.
_BAD = ["best-pills-online", "win-casino-bonus", "spam-links", "adserver-track", "xxx-adult", "bets-for-free", "cheap-meds", "poker-bonus",
        "link-farm", "click-track", "adult-cams", "sports-bets", "payday-loans-fast", "replica-watches", "free-prize-win", "popup-ads",
        "hot-singles", "slot-casino", "adult-chat", "adult-photo", "adults-only", "adult-movie", "xadult", "adult-date", "freebet",
        "free-spins", "free-poker", "bets-bonus", "pills-shop", "cheap-viagra", "diet-pills", "casino-online", "royal-casino", "win-prizes",
        "spam-blast", "mail-spam", "farm-links", "content-farm", "ads-click", "tracker-ads", "ad-track", "banner-ads"]
_GOOD = ["library", "museum", "weather", "gardening", "kitchen-notes", "history", "science-news", "travel", "music", "school", "river",
         "mountain-club", "therapist", "thermal", "station", "nation", "theatre", "threads", "thinking", "tissue", "author", "heritage",
         "mention", "running-blog", "thirty-days", "northern", "edition", "attention", "whether", "earth", "oncology", "ingredients",
         "university", "hospital", "bakery", "photography", "architecture", "football", "recipes", "poetry", "theory", "pathway",
         "cathedral", "rhythm"]
_SITES = ["example.com", "example.net", "example.org"]
_SUBS = ["", "www.", "m.", "blog."]
_PATHS = ["/en/12", "/de/345/", "/fr/6789?page=2", "/es/77.html", "/en/901#top", "/fr/55?utm_source=feed"]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in training table (url, label 1 = block): each word under every
    site, with sub-domains and paths dealt alike to both classes."""
    rows = [(f"http://{_SUBS[(i + j) % 4]}{w}.{site}{_PATHS[(2 * i + j) % 6]}", label)
            for label, words in ((1, _BAD), (0, _GOOD)) for i, w in enumerate(words) for j, site in enumerate(_SITES)]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {y}D)" for u, y in rows) + " AS t(url, label)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased (A-Z) host after the first ``://`` and the path up to ``?`` or ``#``; both empty without one."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def rule_column(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule as host + path, its verdict) of the longest rule that fits; NULL where none does.
    A rule fits its host and all sub-domains if the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def gram_buckets(host: Column, path: Column, buckets: int = BUCKETS, sizes: Sequence[int] = GRAMS) -> Column:
    """Distinct hash buckets of the character n-grams of ``^host$`` and ``^path$``."""
    parts = []
    for mark, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(F.lit("^"), path, F.lit("$")))):
        chars = F.filter(F.split(text, ""), lambda c: c != "")
        # the one-element array binds the characters once, instead of splitting again for every gram
        parts.append(F.flatten(F.transform(F.array(chars), _buckets_of_chars(mark, sizes, buckets))))
    return F.array_distinct(F.concat(*parts))


def _buckets_of_chars(mark: str, sizes: Sequence[int], buckets: int):
    def starts(c, n):
        return F.when(F.size(c) >= n, F.sequence(F.lit(0), F.greatest(F.size(c) - n, F.lit(0)))).otherwise(F.array().cast("array<int>"))

    def bucket(c, n):
        return lambda i: F.pmod(F.hash(F.lit(mark), F.concat(*[F.get(c, i + j) for j in range(n)])), F.lit(buckets))

    return lambda c: F.concat(*[F.transform(starts(c, n), bucket(c, n)) for n in sizes])


def train_url_model(labelled: DataFrame, buckets: int = BUCKETS, regularisation: float = 0.002) -> tuple[float, list[float]]:
    """(intercept, weight of each bucket) of a logistic regression for label 1 =
    block. The table must hold both labels and is meant to be small; NULL URLs or
    labels are not used."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    host, path = host_and_path(F.col("url"))
    rows = labelled.where(F.col("url").isNotNull() & F.col("label").isNotNull()).select("label", gram_buckets(host, path, buckets).alias("b"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda i: F.when(F.array_contains(F.col("b"), i), 1.0).otherwise(0.0))
    model = LogisticRegression(regParam=regularisation, maxIter=60, standardization=False) \
        .fit(rows.select("label", array_to_vector(dense).alias("features")).coalesce(1).cache())
    return float(model.intercept), [float(w) for w in model.coefficients.toArray()]


def block_probability(host: Column, path: Column, model: tuple[float, list[float]]) -> Column:
    intercept, weights = model
    folded = F.split(F.lit(",".join(f"{w:.9g}" for w in weights)), ",").cast("array<double>")
    z = F.aggregate(gram_buckets(host, path, len(weights)), F.lit(intercept), lambda a, i: a + F.get(folded, i))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], model: tuple[float, list[float]], threshold: float = 0.5, id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule (NULL where none fits),
    verdict (the rule's, else block where ``p_block`` >= threshold), p_block (the
    model's probability, for every URL).

    A NULL URL or one without ``://`` has empty host and path and is judged by
    the model; NULL ids and repeated rows keep their rows; other columns are not
    read; an empty table gives no rows. The work is linear in a URL's length.
    """
    host, path = host_and_path(F.col("__url"))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("__url")) \
        .select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    return base.withColumn("rule", rule).withColumn("p_block", block_probability(F.col("host"), F.col("path"), model)) \
        .select("page_id", "host", "path", "rule",
                F.coalesce(verdict, F.when(F.col("p_block") >= threshold, "block").otherwise("allow")).alias("verdict"), "p_block")
