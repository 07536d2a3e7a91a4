"""Distributions and ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.functions.expressions import tidy
from rowsmith.operators.describe import (
    class_counts,
    class_ratio,
    count_where,
    densities,
    density,
    histogram,
    value_limits,
)
from rowsmith.plans.inputs import LABEL_SQL, LINE_FEATURES, PREP_FEATURES, PREP_SQL, outcome, prep
from rowsmith.plans.registry import query
from rowsmith.sources.tables import load_table


@query("a1_class_counts", f"WITH {LABEL_SQL} SELECT label, count(*) AS n FROM outcome GROUP BY label")
def a1(spark: SparkSession, folder: str) -> DataFrame:
    return class_counts(outcome(spark, folder), "label")


@query("a2_count_where", "SELECT count(*) AS n FROM lineitem WHERE l_quantity > 25 AND l_tax < 0.04")
def a2(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_table(spark, folder, "lineitem")
    return count_where(rows, (F.col("l_quantity") > 25) & (F.col("l_tax") < 0.04))


@query(
    "a3_class_ratio",
    f"""WITH {LABEL_SQL}, sizes AS (SELECT count(*) FILTER (WHERE label = 0) AS n0,
          count(*) FILTER (WHERE label = 1) AS n1 FROM outcome)
        SELECT n0, n1, round(least(n0, n1) / greatest(n0, n1), 6) + 0.0 AS fraction FROM sizes""",
)
def a3(spark: SparkSession, folder: str) -> DataFrame:
    return class_ratio(outcome(spark, folder), "label").withColumn("fraction", tidy("fraction"))


def _histogram_sql(table: str, column: str, bins: int = 30) -> str:
    return f"""
    SELECT '{column}' AS "column", b.bin, round(b.lo, 6) + 0.0 AS lo, round(b.hi, 6) + 0.0 AS hi,
           count(v) AS n
    FROM (SELECT CAST(i AS INTEGER) AS bin, i * ((hi - lo) / {bins}) + lo AS lo,
                 CASE WHEN i = {bins - 1} THEN hi ELSE (i + 1) * ((hi - lo) / {bins}) + lo END AS hi
          FROM (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi
                FROM {table}), range({bins}) AS r(i)) AS b
    LEFT JOIN (SELECT CAST({column} AS DOUBLE) AS v FROM {table}) AS x
      ON v >= b.lo AND (v < b.hi OR (b.bin = {bins - 1} AND v <= b.hi))
    GROUP BY ALL"""


@query("a4_histogram", " UNION ALL ".join(_histogram_sql("lineitem", c) for c in LINE_FEATURES))
def a4(spark: SparkSession, folder: str) -> DataFrame:
    return histogram(load_table(spark, folder, "lineitem"), LINE_FEATURES)


@query("a4_histogram_continuous", _histogram_sql("events", "value"))
def a4_continuous(spark: SparkSession, folder: str) -> DataFrame:
    return histogram(load_table(spark, folder, "events"), ["value"])


def _density_sql(table: str, column: str, grid: int = 200, bins: int = 30) -> str:
    return f"""
    WITH facts AS (
      SELECT min({column}) AS low, max({column}) AS high, count({column}) AS n,
             stddev_samp({column}) * power(count({column}), -0.2) AS h FROM {table}),
    tally AS (SELECT {column} AS v, count(*) AS w FROM {table} WHERE {column} IS NOT NULL GROUP BY 1),
    points AS (SELECT CAST(i AS INTEGER) AS point, low + i * ((high - low) / {grid - 1}) AS x,
                      low, high, n, h FROM facts, range({grid}) AS r(i)),
    heights AS (
      SELECT point, x, low, high, n,
             sum(w * exp(-0.5 * power((x - v) / h, 2))) / (n * h * sqrt(2 * pi())) AS density
      FROM points, tally GROUP BY point, x, low, high, n, h)
    SELECT point, round(x, 6) + 0.0 AS x, round(density, 6) + 0.0 AS density,
           round(density * n * (high - low) / {bins}, 4) + 0.0 AS scaled
    FROM heights"""


def _shown(found: DataFrame) -> DataFrame:
    return found.select(
        "point", tidy("x").alias("x"), tidy("density").alias("density"), tidy("scaled", 4).alias("scaled")
    )


@query("a5_density", _density_sql("events", "value"))
def a5(spark: SparkSession, folder: str) -> DataFrame:
    """Exact, over every value of a continuous column."""
    return _shown(density(load_table(spark, folder, "events"), "value"))


@query(
    "a5_density_codes",
    _density_sql("lineitem", "l_quantity"),
)
def a5_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Exact, over the counts of a coded column."""
    return _shown(density(load_table(spark, folder, "lineitem"), "l_quantity"))


_DENSITY_COLUMNS = [*LINE_FEATURES, "l_extendedprice"]


@query(
    "a5_densities",
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", * FROM ({_density_sql('lineitem', c)})""" for c in _DENSITY_COLUMNS),
)
def a5_all(spark: SparkSession, folder: str) -> DataFrame:
    """All columns in one call; a constant column beside them is left out."""
    rows = load_table(spark, folder, "lineitem").withColumn("constant", F.lit(1))
    found = densities(rows, [*_DENSITY_COLUMNS, "constant"])
    return found.select(
        "column", "point", tidy("x").alias("x"), tidy("density").alias("density"), tidy("scaled", 4).alias("scaled")
    )


@query(
    "a11_value_limits",
    f"WITH {PREP_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) - 1 AS low,
            CAST(max({c}) AS DOUBLE) + 1 AS high FROM prep"""
        for c in PREP_FEATURES
    ),
)
def a11(spark: SparkSession, folder: str) -> DataFrame:
    return value_limits(prep(spark, folder), PREP_FEATURES, pad_abs=1)
