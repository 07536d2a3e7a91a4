"""Corpus pipeline: five stages from raw documents to encoded ones.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again
before the next one. The first four keep the columns of documents.

1. quality_rules: rejected documents go, failed lines of the others too.
2. simhash_dedup: one document of every group of near copies stays, that with the smallest id.
3. decontaminate: documents with words of a benchmark window go.
4. secrets: secrets are replaced by a mark; every document stays.
5. bpe: ids of every document, with digests of ids and of the decoded text.

``n_chars`` follows a text that a stage changes; it stays null where it was null. Empty tables pass through
all stages; other cases are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.llm import bpe, decontaminate, quality_rules, secrets, simhash
from rowsmith.llm.common import materialise, table
from rowsmith.llm.queries import VOCABULARY


def _count_chars(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(kind))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _count_chars(quality_rules.keep_good(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _count_chars(secrets.redact(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, VOCABULARY)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("bpe", bpe_stage),
]

# SQL can express neither the fingerprints' components nor the encoding: tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
