"""Distributions: class counts, histograms, densities, value ranges."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.functions.expressions import tidy


def _number(column: str) -> Column:
    """The value as a double; NaN counts as missing, like null."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def count_where(df: DataFrame, predicate: Column) -> DataFrame:
    """A filter rather than a conditional count, so that the scan can skip by it."""
    return df.filter(predicate).agg(F.count(F.lit(1)).alias("n"))


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """One row (n0, n1, fraction) for a 0/1 label. ``fraction`` is smaller over larger class
    whichever value that is, and null when a class is absent."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    small, large = F.least("n0", "n1"), F.greatest("n0", "n1")
    return counts.withColumn("fraction", F.when(small > 0, small / large))


def value_limits(
    df: DataFrame,
    cols: Sequence[str],
    pad_abs: float | None = None,
    pad_rel: float | None = None,
) -> DataFrame:
    """Rows (column, low, high): the range of each column, widened by a fixed amount or by
    a share of each limit's size, so that the range always holds its data."""
    ends = df.agg(
        *[F.min(c).cast("double").alias(f"__low{i}") for i, c in enumerate(cols)],
        *[F.max(c).cast("double").alias(f"__high{i}") for i, c in enumerate(cols)],
    )
    shift, share = pad_abs or 0.0, pad_rel or 0.0
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(f"__low{i}") - F.abs(f"__low{i}") * share - shift).alias("low"),
            (F.col(f"__high{i}") + F.abs(f"__high{i}") * share + shift).alias("high"),
        )
        for i, c in enumerate(cols)
    ]
    return ends.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Rows (column, bin, lo, hi, n) of equal-width bins between each column's ends.

    Bins are half open, the last one is closed, empty bins are listed, nulls are skipped, and
    a constant column has one bin. One pass finds the ends and one counts all columns; rows
    combine before the shuffle, which moves at most columns x bins rows per task.
    """
    ends = df.agg(
        *[F.min(_number(c)).alias(f"__low{i}") for i, c in enumerate(cols)],
        *[F.max(_number(c)).alias(f"__high{i}") for i, c in enumerate(cols)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"__low{i}").alias("low"),
            F.col(f"__high{i}").alias("high"),
            ((F.col(f"__high{i}") - F.col(f"__low{i}")) / bins).alias("step"),
        )
        for i, c in enumerate(cols)
    ]
    # One row per column.
    ranges = ends.select(F.inline(F.array(*entries))).filter(F.col("low").isNotNull())

    def edge(place: Column) -> Column:
        return place * F.col("step") + F.col("low")

    # The division can land next to an edge, so the edges themselves decide.
    value, guess = F.col("value"), F.col("guess")
    single = F.col("low") == F.col("high")
    share = (value - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    too_high = F.when(value < edge(guess), 1).otherwise(0)
    too_low = F.when((guess < bins - 1) & (value >= edge(guess + 1)), 1).otherwise(0)
    counts = (
        df.select(*[_number(c).alias(c) for c in cols])
        .unpivot([], list(cols), "column", "value")
        .filter(value.isNotNull())
        .join(F.broadcast(ranges), "column")
        .withColumn("guess", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int"))
        .select("column", F.when(single, 0).otherwise(guess - too_high + too_low).alias("bin"))
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    last = F.when(single, F.lit(0)).otherwise(F.lit(bins - 1))
    every = ranges.select("*", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    closed = single | (F.col("bin") == bins - 1)
    return every.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        tidy(edge(F.col("bin"))).alias("lo"),
        tidy(F.when(closed, F.col("high")).otherwise(edge(F.col("bin") + 1))).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


# Fast Gauss transform: cells of CELL bandwidths (of the kernel exp(-x^2)), TERMS terms a cell, points up to REACH away.
CELL = 0.5
TERMS = 16
REACH = 7.0


def transform_error(terms: int = TERMS, cell: float = CELL, reach: float = REACH) -> float:
    """Bound of the error that one value adds to a sum of kernels of height 1.

    Terms from ``terms`` on are left out. By Cramer's bound the n-th is at most 1.09 * (sqrt(2) * cell / 2)**n / sqrt(n!).
    Points farther than ``reach`` from a cell's middle are left out, where a kernel is below exp(-(reach - cell / 2)**2).
    """
    ratio = math.sqrt(2) * cell / 2
    first = 1.09 * ratio**terms / math.sqrt(math.factorial(terms))
    return first / (1 - ratio / math.sqrt(terms + 1)) + math.exp(-((reach - cell / 2) ** 2))


def densities(
    df: DataFrame, cols: Sequence[str], grid: int = 200, bins: int = 30, prebin: int | None = None
) -> DataFrame:
    """Rows (column, point, x, density, scaled): a Gaussian kernel density of every column on
    ``grid`` points. Columns without two different values are left out.

    The bandwidth is Scott's, s * n**(-1/5); ``scaled`` matches the counts of a histogram
    with ``bins`` bins. One small job reads the ends, spread and size of all columns first.

    The sums are a fast Gauss transform: values fall into cells of about a third of a bandwidth, each cell keeps
    ``TERMS`` sums of powers of their distance from its middle, and its Hermite series gives the cell's share of every
    grid point in reach. The power sums of all columns are one aggregate that combines in the tasks; what is kept is a row per occupied cell,
    whatever the number of rows and grid points. A height is within ``transform_error()`` (2e-14) times the number of values
    of the exact sum. ``prebin`` moves values to the middle of that many equal cells first.
    """
    found = _densities(df, cols, grid, bins, prebin)
    if found is None:
        return df.sparkSession.createDataFrame([], "column string, point int, x double, density double, scaled double")
    return found


def _densities(df: DataFrame, cols: Sequence[str], grid: int, bins: int, prebin: int | None) -> DataFrame | None:
    """None if no column has two different values."""
    found = df.agg(
        *[
            F.struct(
                F.min(_number(c)).alias("low"),
                F.max(_number(c)).alias("high"),
                F.stddev_samp(_number(c)).alias("spread"),
                F.count(_number(c)).alias("n"),
            ).alias(f"__facts{i}")
            for i, c in enumerate(cols)
        ]
    ).head()
    facts = {c: found[i] for i, c in enumerate(cols)}
    facts = {c: f for c, f in facts.items() if f["n"] >= 2 and f["spread"] and f["spread"] > 0}
    if not facts:
        return None
    rows = [
        (c, float(f["low"]), (f["high"] - f["low"]) / (grid - 1), f["spread"] * f["n"] ** (-0.2), float(f["n"]))
        for c, f in facts.items()
    ]
    known = df.sparkSession.createDataFrame(rows, "column string, low double, step double, width double, n double")
    known = known.withColumn("unit", F.col("width") * math.sqrt(2)).withColumn("side", F.col("unit") * CELL)
    values = df.select(*[_number(c).alias(c) for c in facts]).unpivot([], list(facts), "column", "v").filter("v is not null")
    values = values.join(F.broadcast(known), "column")  # one row per column
    if prebin is not None:
        cell = F.col("step") * (grid - 1) / prebin
        index = F.least(F.floor((F.col("v") - F.col("low")) / cell), F.lit(prebin - 1))
        values = values.withColumn("v", F.col("low") + (index + 0.5) * cell)
    middle = F.col("low") + (F.col("cell") + 0.5) * F.col("side")
    values = values.withColumn("cell", F.floor((F.col("v") - F.col("low")) / F.col("side")))
    values = values.select("column", "cell", ((F.col("v") - middle) / F.col("unit")).alias("t"))
    powers = [F.count(F.lit(1)).cast("double"), F.sum("t"), *[F.sum(F.pow("t", F.lit(float(i)))) for i in range(2, TERMS)]]
    cells = values.groupBy("column", "cell").agg(*[p.alias(f"a{i}") for i, p in enumerate(powers)])
    # The series from its last term to its first, as Clenshaw's recurrence needs it.
    terms = F.array(*[F.struct(F.lit(float(i + 1)).alias("n"), (F.col(f"a{i}") / math.factorial(i)).alias("a")) for i in reversed(range(TERMS))])
    cells = cells.select("column", "cell", terms.alias("terms")).join(F.broadcast(known), "column")
    first = F.greatest(F.ceil((middle - REACH * F.col("unit") - F.col("low")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((middle + REACH * F.col("unit") - F.col("low")) / F.col("step")), F.lit(grid - 1))
    near = cells.withColumn("points", F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))))
    near = near.select("column", "terms", middle.alias("middle"), "low", "step", "unit", F.explode("points").alias("point"))
    away = (F.col("low") + F.col("point") * F.col("step") - F.col("middle")) / F.col("unit")
    near = near.select("column", "point", "terms", away.alias("away"))
    zero = F.struct(F.lit(0.0).alias("b1"), F.lit(0.0).alias("b2"))
    series = F.aggregate(
        "terms",
        zero,
        lambda s, t: F.struct((t["a"] + 2 * F.col("away") * s["b1"] - 2 * t["n"] * s["b2"]).alias("b1"), s["b1"].alias("b2")),
    )["b1"]
    heights = near.groupBy("column", "point").agg(F.sum(series * F.exp(-F.col("away") * F.col("away"))).alias("height"))
    every = known.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    points = every.join(F.broadcast(heights), ["column", "point"], "left")  # columns x grid rows
    height = F.greatest(F.coalesce("height", F.lit(0.0)), F.lit(0.0))
    share = height / (F.col("n") * F.col("width") * math.sqrt(2 * math.pi))
    return points.select(
        "column",
        "point",
        (F.col("low") + F.col("point") * F.col("step")).alias("x"),
        share.alias("density"),
        (share * F.col("n") * F.col("step") * (grid - 1) / bins).alias("scaled"),
    )


def density(
    df: DataFrame, col: str, grid: int = 200, bins: int = 30, prebin: int | None = None
) -> DataFrame:
    """Rows (point, x, density, scaled) of one column, which must have two different values."""
    found = _densities(df, [col], grid, bins, prebin)
    if found is None:
        raise ValueError(f"a density of {col} needs at least two different values")
    return found.drop("column")
