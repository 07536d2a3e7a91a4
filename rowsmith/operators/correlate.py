"""Correlation of numeric columns, with each other and with a label."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from rowsmith.functions.moments import co_moments
from rowsmith.functions.prefix import BUCKET_ROWS, bucket_limits, running_totals, value_counts, with_buckets
from rowsmith.operators.align import lookup
from rowsmith.session import written

# A column's rank table is broadcast up to this many distinct values (a few megabytes).
BROADCAST_VALUES = 100_000
BROADCAST_COLUMNS = 16


def _complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Listwise deletion: only rows in which every column has a value."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()


def _ranks(counts: DataFrame, rows_per_bucket: int) -> DataFrame:
    """Rows (column, value, n, rank) from counts with one row per (column, value)."""
    limits = bucket_limits(counts, rows_per_bucket)
    return running_totals(with_buckets(counts, limits), ["n"], limits).select(
        "column", "value", "n", (F.col("before_n") + (F.col("n") + 1) / 2).alias("rank")
    )


def rank_table(df: DataFrame, cols: Sequence[str], rows_per_bucket: int = BUCKET_ROWS) -> DataFrame:
    """Rows (column, value, n, rank): the rank of every distinct value, ties averaged."""
    return _ranks(value_counts(df, cols), rows_per_bucket)


def _replace_by_rank(rows: DataFrame, cols: Sequence[str], ranks: DataFrame) -> DataFrame:
    """Every value replaced by its rank.

    Columns with few distinct values (codes) are served by broadcast tables inside one stage.
    All others, and codes beyond the first sixteen, go through one long table (row, column, value): one join with the ranks, in
    which heavy values are spread, and one grouping back by row. Two narrow shuffles, however
    many columns there are.
    """
    sizes = {r["column"]: r["count"] for r in ranks.groupBy("column").count().collect()}
    codes = [c for c in cols if sizes.get(c, 0) <= BROADCAST_VALUES][:BROADCAST_COLUMNS]
    wide = [c for c in cols if c not in codes]
    if wide:
        # Row ids must not change between the two readings below, so they are written.
        rows = written(rows.withColumn("__row", F.monotonically_increasing_id()), "rows")
    for c in codes:
        table = ranks.filter(F.col("column") == c).select(F.col("value").alias("__value"), F.col("rank").alias("__rank"))
        rows = rows.join(F.broadcast(table), F.col(c) == F.col("__value"))
        rows = rows.select(*[F.col("__rank").alias(c) if c == other else other for other in rows.columns if not other.startswith("__") or other == "__row"])
    if not wide:
        return rows.select(*cols)
    table = ranks.filter(F.col("column").isin(wide)).select(
        F.col("column").alias("__column"), F.col("value").alias("__value"), "n", F.col("rank").alias("__rank")
    )
    long = rows.select("__row", *cols).unpivot(["__row", *codes], wide, "column", "value")
    served = lookup(long, table, {"column": "__column", "value": "__value"}, ["__rank"], "n")
    back = served.groupBy("__row").agg(
        *[F.first(c).alias(c) for c in codes],
        *[F.max(F.when(F.col("column") == c, F.col("__rank"))).alias(c) for c in wide],
    )
    return back.select(*cols)


def correlation_array(
    df: DataFrame,
    cols: Sequence[str],
    method: str = "spearman",
    rows_per_bucket: int = BUCKET_ROWS,
    nulls: str = "listwise",
) -> np.ndarray:
    """The d x d matrix on the driver; its size depends on the number of columns only.

    One pass of mergeable co-moments. With ``nulls="listwise"`` a row with a null in any column is left out, with "pairwise" it
    counts for all pairs in which it has both values. Spearman's is Pearson's over average ranks, which hang on the rows
    that are left, so it is listwise only. The rank table is kept while the matrix is computed.
    """
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown correlation method: {method}")
    if nulls not in ("listwise", "pairwise") or (nulls == "pairwise" and method == "spearman"):
        raise ValueError(f"no {method} correlation with nulls {nulls}")
    rows, kept = (df if nulls == "pairwise" else _complete(df, cols)), []
    try:
        if method == "spearman":
            ranks = rank_table(rows, cols, rows_per_bucket).persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(ranks)
            rows = _replace_by_rank(rows, cols, ranks)
        return co_moments(rows, cols).correlation()
    finally:
        for frame in kept:
            frame.unpersist()


def _matrix_frame(df: DataFrame, cols: Sequence[str], matrix: np.ndarray) -> DataFrame:
    schema = ", ".join(["feature string", *[f"`{c}` double" for c in cols]])
    rows = [(c, *map(float, matrix[i])) for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, schema)


def pearson_matrix(df: DataFrame, cols: Sequence[str], nulls: str = "listwise") -> DataFrame:
    """One row per feature, named in ``feature``, and one column per feature; ``nulls`` as in :func:`correlation_array`."""
    return _matrix_frame(df, cols, correlation_array(df, cols, "pearson", nulls=nulls))


def pair_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (feature_a, feature_b, n, mean_a, covariance): what stands behind a pairwise matrix; null without a value."""
    found = co_moments(df, cols)
    spread = found.covariance()
    rows = [
        (a, b, int(found.n[i, j]), float(found.mean[i, j]) if found.n[i, j] else None, float(spread[i, j]) if found.n[i, j] > 1 else None)
        for i, a in enumerate(found.cols)
        for j, b in enumerate(found.cols)
    ]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, n long, mean_a double, covariance double")


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _matrix_frame(df, cols, correlation_array(df, cols, "spearman"))


def correlation_long(df: DataFrame, cols: Sequence[str], method: str = "spearman") -> DataFrame:
    """Rows (feature_a, feature_b, corr)."""
    wide = _matrix_frame(df, cols, correlation_array(df, cols, method))
    return wide.withColumnRenamed("feature", "feature_a").unpivot(
        "feature_a", list(cols), "feature_b", "corr"
    )


def _label_pearson(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    # Not corr(): under ANSI arithmetic it fails on a constant column.
    found = rows.agg(
        F.stddev_pop(label).alias("__label"),
        *[F.covar_pop(c, label).alias(f"__both{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(c).alias(f"__own{i}") for i, c in enumerate(features)],
    )

    def ratio(i: int) -> Column:
        spread = F.col("__label") * F.col(f"__own{i}")
        return F.when(spread > 0, F.col(f"__both{i}") / spread).otherwise(F.lit(float("nan")))

    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), ratio(i).alias("corr"))
        for i, c in enumerate(features)
    ]
    return found.select(F.inline(F.array(*entries)))


def _label_spearman(
    rows: DataFrame, features: Sequence[str], label: str, rows_per_bucket: int
) -> DataFrame:
    """Everything the coefficient needs is in the counts of (feature value, label value), which
    one pass over the rows gives. Values of features and of the label are ranked from sums of that
    table and joined back to it, never to the rows; heavy values are spread in the joins."""
    pairs = value_counts(rows, features, keep=[label])
    by_value = written(pairs.groupBy("column", "value").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pairs")), "values")
    # Every feature has all rows, so the label's counts are those beside any one of them.
    of_label = (
        pairs.filter(F.col("column") == features[0])
        .groupBy(F.col(label).alias("value"))
        .agg(F.sum("n").alias("n"))
        .select(F.lit(label).alias("column"), "value", "n")
    )
    of_label = written(of_label, "labels")
    beside = pairs.groupBy(F.col(label).alias("value")).agg(F.count(F.lit(1)).alias("pairs"))
    rx = _ranks(by_value.select("column", "value", "n"), rows_per_bucket).join(
        by_value.select("column", "value", "pairs"), ["column", "value"]
    )
    ry = _ranks(of_label, rows_per_bucket).join(beside, "value")
    rx = written(rx.select(F.col("column").alias("__column"), F.col("value").alias("__value"), F.col("rank").alias("rx"), "pairs"), "ranks")
    ry = written(ry.select(F.col("value").alias("__label"), F.col("rank").alias("ry"), "pairs"), "ranks")
    total = of_label.agg(F.sum("n")).head()[0] or 0
    middle = F.lit((total + 1) / 2)
    dx, dy = F.col("rx") - middle, F.col("ry") - middle
    ranked = lookup(pairs, rx, {"column": "__column", "value": "__value"}, ["rx"], "pairs")
    ranked = lookup(ranked, ry, {label: "__label"}, ["ry"], "pairs")
    sums = ranked.groupBy("column").agg(
        F.sum(F.col("n") * dx * dy).alias("sxy"),
        F.sum(F.col("n") * dx * dx).alias("sxx"),
        F.sum(F.col("n") * dy * dy).alias("syy"),
    )
    spread = F.sqrt(F.col("sxx")) * F.sqrt(F.col("syy"))
    place = F.create_map(*[F.lit(v) for i, c in enumerate(features) for v in (c, i)])
    return sums.select(
        F.element_at(place, F.col("column")).alias("position"),
        F.col("column").alias("feature"),
        F.when(spread > 0, F.col("sxy") / spread).otherwise(F.lit(float("nan"))).alias("corr"),
    )


def label_correlation(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    method: str = "spearman",
    rows_per_bucket: int = BUCKET_ROWS,
) -> DataFrame:
    """Rows (position, feature, corr) of every feature against the label, in one aggregate
    for all features. A constant column has NaN."""
    rows = _complete(df, [*features, label])
    if method == "pearson":
        return _label_pearson(rows, features, label)
    if method == "spearman":
        return _label_spearman(rows, features, label, rows_per_bucket)
    raise ValueError(f"unknown correlation method: {method}")


def top_correlated(
    df: DataFrame, features: Sequence[str], label: str, k: int = 4, method: str = "spearman"
) -> DataFrame:
    """The k features that correlate most with the label, strongest first; ties keep column
    order and NaN never ranks."""
    found = label_correlation(df, features, label, method).filter(~F.isnan("corr"))
    return found.orderBy(F.abs("corr").desc(), "position").limit(k)


def select_correlated(
    df: DataFrame, features: Sequence[str], label: str, k: int = 4, method: str = "spearman"
) -> list[str]:
    """Names of the chosen features with the label at the end; k names reach the driver."""
    best = top_correlated(df, features, label, k, method)
    return [row["feature"] for row in best.collect()] + [label]
