"""Rebalancing, splits and folds, all decided by the key's hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.operators.resample import (
    kfold,
    no_sampling,
    oversample,
    train_test_split,
    undersample,
)
from rowsmith.plans.inputs import LABEL_SQL, outcome
from rowsmith.plans.registry import query


def hash_sql(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5({key} || ':{seed}'), 1, 8) AS BIGINT)"


# Here label 1 is the smaller class.
_SIZES = f"""
{LABEL_SQL}, sizes AS (
  SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM outcome)
"""


@query(
    "m1_undersample",
    f"""WITH {_SIZES} SELECT o_orderkey, label FROM outcome, sizes
        WHERE label = 1 OR {hash_sql('o_orderkey', 42)} < n1 / n0 * 4294967296""",
)
def m1(spark: SparkSession, folder: str) -> DataFrame:
    return undersample(outcome(spark, folder), "label", "o_orderkey")


@query(
    "m1_undersample_exact",
    f"""WITH {_SIZES}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY label ORDER BY {hash_sql('o_orderkey', 42)}, o_orderkey) AS turn
          FROM outcome)
        SELECT o_orderkey, label FROM ranked, sizes WHERE label = 1 OR turn <= n1""",
)
def m1_exact(spark: SparkSession, folder: str) -> DataFrame:
    return undersample(outcome(spark, folder), "label", "o_orderkey", mode="exact")


@query(
    "m2_oversample",
    f"""WITH {_SIZES}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY label ORDER BY {hash_sql('o_orderkey', 42)}, o_orderkey) AS turn
          FROM outcome)
        SELECT o_orderkey, label, CAST(unnest(range(1, CAST(CASE WHEN label = 0 THEN 1
            ELSE n0 // n1 + CASE WHEN turn <= n0 % n1 THEN 1 ELSE 0 END END AS BIGINT) + 1)) AS INTEGER) AS copy
        FROM ranked, sizes""",
)
def m2(spark: SparkSession, folder: str) -> DataFrame:
    return oversample(outcome(spark, folder), "label", "o_orderkey")


@query(
    "m3_train_test_split",
    f"""WITH {LABEL_SQL} SELECT o_orderkey, label,
        CASE WHEN {hash_sql('o_orderkey', 1234)} < 0.8 * 4294967296 THEN 'train' ELSE 'test' END AS part
        FROM outcome""",
)
def m3(spark: SparkSession, folder: str) -> DataFrame:
    train, test = train_test_split(outcome(spark, folder), "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "m4_kfold",
    f"""WITH {LABEL_SQL} SELECT o_orderkey, CAST({hash_sql('o_orderkey', 1234)} % 3 AS INTEGER) AS fold
        FROM outcome""",
)
def m4(spark: SparkSession, folder: str) -> DataFrame:
    return kfold(outcome(spark, folder), "o_orderkey", 3).select("o_orderkey", "fold")


@query("m5_no_sampling", f"WITH {LABEL_SQL} SELECT o_orderkey, label FROM outcome")
def m5(spark: SparkSession, folder: str) -> DataFrame:
    """The rows themselves, unchanged."""
    return no_sampling(outcome(spark, folder)).select("o_orderkey", "label")
