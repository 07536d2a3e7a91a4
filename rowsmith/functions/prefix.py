"""Running totals over ordered values without a single-task window.

A plain ``sum() over (order by value)`` sends the whole column to one task. Here rows are
first counted per (column, value), in one pass whose small result is written. Everything else
reads that table: the number of distinct values, the limits that cut them into buckets of
bounded size, the sums per bucket and the few bucket totals, which are accumulated separately.
The bucket limits only balance the work: any limits give the same, exact result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsmith.session import written

BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 10_000


Limits = dict[str, list[float]]


def value_counts(
    df: DataFrame,
    cols: Sequence[str],
    keep: Sequence[str] = (),
    carry: Sequence[str] = (),
    amounts: dict[str, Column] | None = None,
) -> DataFrame:
    """Written table (column, value, *keep, amounts), one row per distinct combination.

    ``amounts`` maps a name to an aggregate, which may use the ``carry`` columns; the default
    is the row count ``n``. The input is read once.
    """
    aggregates = amounts or {"n": F.count(F.lit(1))}
    names = {k: f"__keep_{k}" for k in [*keep, *carry]}
    wide = df.select(
        *[F.col(c).cast("double").alias(c) for c in cols],
        *[F.col(k).alias(n) for k, n in names.items()],
    )
    counts = (
        wide.unpivot(list(names.values()), list(cols), "column", "value")
        .filter(F.col("value").isNotNull())
        .select("column", "value", *[F.col(n).alias(k) for k, n in names.items()])
        .groupBy("column", "value", *keep)
        .agg(*[expr.alias(name) for name, expr in aggregates.items()])
    )
    return written(counts, "value-counts")


def bucket_limits(counts: DataFrame, rows_per_bucket: int = BUCKET_ROWS) -> Limits:
    """Inner limits of the value buckets per column; empty for columns that fit in one.

    ``counts`` has one row per distinct (column, value), so the quantiles are those of distinct
    values and no value's frequency can fill a bucket. However many columns there are, one job counts
    their values and one merges a quantile sketch for each column that is cut.
    """
    sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}
    pieces = {c: min(MAX_BUCKETS, -(-size // rows_per_bucket)) for c, size in sizes.items() if size > rows_per_bucket}
    limits: Limits = {c: [] for c in sizes}
    if not pieces:
        return limits
    most = max(pieces.values())
    shares = [i / most for i in range(1, most)]
    large = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("value", shares, 4 * most).alias("at")
    )
    for row in large.filter(F.col("n") > rows_per_bucket).collect():
        wanted = pieces[row["column"]]
        limits[row["column"]] = sorted({row["at"][round(i * most / wanted) - 1] for i in range(1, wanted)})
    return limits


def with_buckets(counts: DataFrame, limits: Limits) -> DataFrame:
    """Add the bucket of every (column, value): the number of the column's limits that are not above the value.

    The limits are one array per column, at most ``MAX_BUCKETS`` long, and each row bisects its column's array.
    """
    split = {c: at for c, at in limits.items() if at}
    if not split:
        return counts.withColumn("bucket", F.lit(0))
    depth = max(len(at) for at in split.values()).bit_length()
    filled = [(c, [*at, *[float("inf")] * ((1 << depth) - 1 - len(at))]) for c, at in split.items()]
    known = counts.sparkSession.createDataFrame(filled, "column string, __limits array<double>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(depth))])
    place = F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: low + F.when(F.get("__limits", low + step - 1) <= F.col("value"), step).otherwise(0),
    )
    return (
        counts.join(F.broadcast(known), "column", "left")  # one row per column
        .withColumn("bucket", F.when(F.col("__limits").isNull(), 0).otherwise(place))
        .drop("__limits")
    )


def running_totals(counts: DataFrame, amounts: Sequence[str], limits: Limits) -> DataFrame:
    """Add ``before_<amount>``, the column's total over all strictly smaller values.

    ``counts`` has one row per (column, value), with its bucket from :func:`with_buckets`.
    """
    inside = Window.partitionBy("column", "bucket").orderBy("value")
    through = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = counts.select(
        "*",
        *[F.sum(a).over(through).alias(f"__through_{a}") for a in amounts],
    )
    before = {a: F.col(f"__through_{a}") - F.col(a) for a in amounts}
    if any(limits.values()):
        per_bucket = counts.groupBy("column", "bucket").agg(
            *[F.sum(a).alias(f"__sum_{a}") for a in amounts]
        )
        # At most columns x MAX_BUCKETS rows, so one task per column is enough here.
        earlier = (
            Window.partitionBy("column").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        )
        offsets = per_bucket.select(
            "column",
            "bucket",
            *[F.coalesce(F.sum(f"__sum_{a}").over(earlier), F.lit(0)).alias(f"__off_{a}") for a in amounts],
        )
        local = local.join(F.broadcast(offsets), ["column", "bucket"])
        before = {a: total + F.col(f"__off_{a}") for a, total in before.items()}
    return local.select(
        *counts.columns,
        *[total.alias(f"before_{a}") for a, total in before.items()],
    )
