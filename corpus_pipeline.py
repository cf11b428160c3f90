"""The corpus pipeline: five stages over ``documents``, each one operator.

Every stage works on all rows that its predecessor kept. All but the last return
the columns of ``documents``; the last adds the mix's columns to the sampled rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.decontaminate import drop_leaks
from lotwise.llm.mixing import mix, rake
from lotwise.llm.pii import redact_pii
from lotwise.llm.quality import keep_quality
from lotwise.llm.simhash import drop_near_duplicates
from lotwise.llm.tables import materialise, small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on ``labels``, accepts."""
    small_batches(spark)
    return keep_quality(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component."""
    small_batches(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    small_batches(spark)
    return drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the new text."""
    small_batches(spark)
    return redact_pii(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents, with topic, n_tokens, weight and probability (which
    replace columns of these names). Empty documents have no tokens and so no part
    in the mix."""
    small_batches(spark)
    docs = docs.drop("topic", "n_tokens", "weight", "probability")
    return mix(docs, rake(docs)).where("__sampled").drop("__sampled") \
        .withColumnsRenamed({"__topic": "topic", "__n": "n_tokens", "__w": "weight", "__p": "probability"}) \
        .withColumns({"weight": F.round("weight", 9), "probability": F.round("probability", 9)})


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("mixing", mixing)]

#: Trained models and connected components have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
