"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowsmith.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hidden(name: str) -> str:
    """A column name that no input can hold already."""
    return f"__{name}_{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


TEXT_BATCH_ROWS = 1_000


def text_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of at most ``TEXT_BATCH_ROWS`` rows, for this session.

    Spark's own 10,000 rows are meant for numbers; with texts a batch, which is held several
    times on its way, would fill up to the byte limit of a batch.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def settled(flag: Column) -> Column:
    """The same flag, worked out in the projection that names it.

    A filter on a plain flag is pushed below the projection, which repeats all of the expressions
    behind it there. A partition's number is never negative, but Spark does not move it.
    """
    return flag & (F.spark_partition_id() >= 0)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


HOT_PARTS = 1_000
HOT_ROWS = 2_000


def join_split(rows: DataFrame, facts: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with ``facts`` (one row per key, ``count`` of them in ``rows``).

    Keys with over a thousandth of all rows, at most 1,000 of them, are answered by
    broadcast; only the others are shuffled. ``rows`` and ``facts`` are read twice, so both should be
    written tables.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    limit = max(HOT_ROWS, total // HOT_PARTS)
    hot = facts.filter(F.col(count) > limit).drop(count)
    cold = facts.filter(F.col(count) <= limit).drop(count)
    many = rows.join(F.broadcast(hot), key)
    few = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return many.unionByName(few)
