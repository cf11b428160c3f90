"""Registered queries of the training-data operators, with production parameters.

Each ``opN_<name>`` reads its whole table and returns the operator's full result.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@register("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from .token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import fingerprint_documents
    return fingerprint_documents(table(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+')"


def _shingle_sql(table_name: str, key: str) -> str:
    """(key, shingle): distinct runs of five words, fewer words as one."""
    return (f"SELECT DISTINCT {key}, unnest(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' '))) AS shingle "
            f"FROM (SELECT {key}, {_WORDS} AS ws FROM {table_name}) WHERE len(ws) > 0")


@register("op4_decontamination", f"""
WITH d AS ({_shingle_sql("documents", "doc_id")}), i AS MATERIALIZED ({_shingle_sql("benchmark", "item_id")}),
size AS (SELECT item_id, count(*)::INTEGER AS n_shingles FROM i GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*)::INTEGER AS n_matched FROM d JOIN i USING (shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_matched::DOUBLE / n_shingles AS containment, n_matched, n_shingles FROM hit JOIN size USING (item_id)
WHERE n_matched >= 0.8 * n_shingles - 1e-9""")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_leaks
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii
    return find_pii(table(spark, sf_dir, "documents"))


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@register("op6_url_filters")
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls, labelled_urls, train_url_model
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES, train_url_model(labelled_urls(spark)))


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def _register_mixing():
    from .mixing import mixture, mixture_sql

    @register("op3_mixing", mixture_sql())
    def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mixture(table(spark, sf_dir, "documents"))


_register_mixing()


@register("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


@register("op1_fuzzy_passages")
def op1_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fuzzy_passages import find_passages
    return find_passages(table(spark, sf_dir, "documents"))


@register("op11_language_id")
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify_languages
    return identify_languages(table(spark, sf_dir, "documents"))


def _register_importance():
    from .importance import RESAMPLE_SQL, resample

    @register("op12_importance", RESAMPLE_SQL)
    def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
        return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
            .select("doc_id", "n_features", "weight", "score", "rank")


_register_importance()


@register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"))
