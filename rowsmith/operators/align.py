"""Joins: aligning features with labels, pending work, and group facts per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.functions.expressions import same_value
from rowsmith.session import scratch_path, written

# A key counts as hot when it holds more than this share of the rows, so there are at most
# 1 / HOT_SHARE hot keys and the table of them can always be broadcast.
HOT_SHARE = 0.001
SALTS = 4096


def align(x: DataFrame, y: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of both frames that share a key."""
    return x.join(y, [key] if isinstance(key, str) else list(key), "inner")


def align_outer(x: DataFrame, y: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of both frames side by side; rows without a partner keep nulls."""
    return x.join(y, [key] if isinstance(key, str) else list(key), "full_outer")


def _tagged(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows with an increasing id, and the columns that name their piece of the input.

    Pieces of files are told by path and place in the file, since Spark deals them out by
    size and not by name. Other inputs have no files: their partitions are the pieces, and the
    rows are written once so that both passes below see the same ones.
    """
    spark = df.sparkSession
    # monotonically_increasing_id is (partition << 33) + place in the partition.
    row_id = F.monotonically_increasing_id()
    try:
        places = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
        return df.select("*", *places, row_id.alias("__id")), ["__file", "__block"]
    except AnalysisException:
        pass
    path = scratch_path(spark, "positions")
    tagged = df.withColumn("__id", row_id).withColumn("__block", F.shiftright("__id", 33))
    tagged.write.parquet(path)
    return spark.read.schema(tagged.schema).parquet(path), ["__block"]


def _numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Rows with their position, and how many there are."""
    tagged, piece = _tagged(df)
    # One row per piece of the input.
    sizes = tagged.groupBy(*piece).agg(F.count(F.lit(1)).alias("__size"), F.min("__id").alias("__least")).collect()
    start, starts = 0, []
    for row in sorted(sizes, key=lambda r: [r[c] for c in piece]):
        starts.append((*[row[c] for c in piece], start - row["__least"]))
        start += row["__size"]
    kinds = ", ".join(f"{c} {'string' if c == '__file' else 'long'}" for c in piece)
    offsets = df.sparkSession.createDataFrame(starts, f"{kinds}, __offset long")
    placed = tagged.join(F.broadcast(offsets), piece).withColumn(name, F.col("__id") + F.col("__offset"))
    return placed.select(*df.columns, name), start


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Add the row's place 0..n-1, without sorting and without Python rows.

    Rows read from files are numbered by file name and place in the file, whatever partitions
    Spark reads them in; other rows in the order of their partitions.
    """
    return _numbered(df, name)[0]


def align_by_position(x: DataFrame, y: DataFrame) -> DataFrame:
    """Row i of x beside row i of y, however the two are partitioned or cut into files.

    Raises ValueError when the frames differ in length: then no pairing is right.
    """
    place = "__position"
    left, rows = _numbered(x, place)
    right, others = _numbered(y, place)
    if rows != others:
        raise ValueError(f"{rows} rows cannot be paired with {others}")
    return align(left, right, place).drop(place)


def pending(plan: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Planned experiments that have no score yet."""
    return plan.join(scores.select(*keys), list(keys), "left_anti")


def semi_join(df: DataFrame, kept: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of df whose values in ``cols`` occur in ``kept``; nulls match nulls.

    Meant for deduplicated rows, where a value combination has few rows; where one may hold
    a large share of df, use :func:`lookup` or :func:`with_group_facts`.
    """
    names = [f"__kept{i}" for i in range(len(cols))]
    right = kept.select(*[F.col(c).alias(n) for c, n in zip(cols, names)])
    return df.join(right, same_value(map(F.col, cols), map(F.col, names)), "left_semi")


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    payload: Sequence[str],
    weight: str,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add ``payload`` columns of ``table`` (one row per key) to ``df``; nulls match nulls.

    ``on`` maps columns of df to columns of table, ``weight`` is the number of df rows behind
    a table row; the table is read several times, so it should be written or kept. Hot keys are
    answered from a broadcast of the hot part of the table, and their rows are then spread over
    salts, so the shuffle join that serves all other keys never meets a group of more than
    ``hot_share`` of the rows. A salt hangs on the row's values and its partition only: a task that
    runs again gives every row the same one.
    """
    keys = list(on)
    total = table.agg(F.sum(weight)).scalar()

    def part(rows: DataFrame, tag: str) -> DataFrame:
        return rows.select(
            *[F.col(on[k]).alias(f"__{tag}_key{i}") for i, k in enumerate(keys)],
            *[F.col(p).alias(f"__{tag}_{p}") for p in payload],
            F.lit(0 if tag == "cold" else 1).alias(f"__{tag}"),
        )

    is_hot = F.col(weight) > total * F.lit(hot_share)
    hot = part(table.filter(is_hot), "hot")
    cold = part(table.filter(~is_hot), "cold")

    def match(tag: str) -> Column:
        return same_value(
            [F.col(k) for k in keys], [F.col(f"__{tag}_key{i}") for i in range(len(keys))]
        )

    values = [c for c, kind in df.dtypes if "map<" not in kind]  # maps have no hash
    known = df.join(F.broadcast(hot), match("hot"), "left").withColumn(
        "__salt",
        F.when(F.col("__hot") == 1, 1 + F.pmod(F.xxhash64(*values, F.spark_partition_id()), F.lit(SALTS)))
        .otherwise(F.lit(0))
        .cast("int"),
    )
    served = known.join(cold, match("cold") & (F.col("__salt") == F.col("__cold")), "left")
    return served.select(
        *df.columns,
        *[
            F.when(F.col("__hot") == 1, F.col(f"__hot_{p}")).otherwise(F.col(f"__cold_{p}")).alias(p)
            for p in payload
        ],
    )


def with_group_facts(
    df: DataFrame, keys: Sequence[str], facts: Mapping[str, Column], hot_share: float = HOT_SHARE
) -> DataFrame:
    """Add aggregates of the row's group to every row: a window without an order, but one
    that combines before the shuffle and never gathers a group in one task."""
    groups = df.groupBy(*keys).agg(
        *[expr.alias(name) for name, expr in facts.items()], F.count(F.lit(1)).alias("__rows")
    )
    return lookup(df, written(groups, "groups"), {k: k for k in keys}, list(facts), "__rows", hot_share)


def mark_repeated(df: DataFrame, cols: Sequence[str], name: str = "repeated") -> DataFrame:
    """Flag rows whose values in ``cols`` occur more than once."""
    facts = {"__copies": F.count(F.lit(1))}
    return (
        with_group_facts(df, cols, facts).withColumn(name, F.col("__copies") > 1).drop("__copies")
    )
