"""Cleaning and value rules, and the joins behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.operators.align import mark_repeated, semi_join
from rowsmith.operators.quality import (
    between,
    clean,
    drop_contradictions,
    drop_exact_duplicates,
    invalid_rows,
    one_of,
    validity_report,
)
from rowsmith.plans.inputs import LINE_FEATURES, LINE_SQL, PREP_SQL, line, prep
from rowsmith.plans.registry import query

_COLS = ", ".join(LINE_FEATURES)


@query("q1_drop_exact_duplicates", f"WITH {LINE_SQL} SELECT DISTINCT * FROM line")
def q1(spark: SparkSession, folder: str) -> DataFrame:
    return drop_exact_duplicates(line(spark, folder))


_CONSISTENT = f"""
consistent AS (
  SELECT {_COLS} FROM line GROUP BY ALL HAVING count(DISTINCT label) = 1)
"""


@query(
    "q2_drop_contradictions",
    f"WITH {LINE_SQL}, {_CONSISTENT} SELECT line.* FROM line JOIN consistent USING ({_COLS})",
)
def q2(spark: SparkSession, folder: str) -> DataFrame:
    """On the rows as they come, copies included."""
    return drop_contradictions(line(spark, folder), LINE_FEATURES, "label")


@query(
    "q3_clean",
    f"WITH {LINE_SQL}, {_CONSISTENT} SELECT DISTINCT line.* FROM line JOIN consistent USING ({_COLS})",
)
def q3(spark: SparkSession, folder: str) -> DataFrame:
    return clean(line(spark, folder), LINE_FEATURES, "label")


@query(
    "j5_consistent_rows",
    f"""WITH {LINE_SQL}, once AS (SELECT DISTINCT * FROM line), single AS (
          SELECT {_COLS} FROM once GROUP BY ALL HAVING count(*) = 1)
        SELECT * FROM once SEMI JOIN single USING ({_COLS})""",
)
def j5(spark: SparkSession, folder: str) -> DataFrame:
    rows = drop_exact_duplicates(line(spark, folder))
    single = rows.groupBy(*LINE_FEATURES).count().filter("count = 1")
    return semi_join(rows, single, LINE_FEATURES)


@query(
    "w3_mark_repeated",
    f"""WITH {LINE_SQL} SELECT *, count(*) OVER (PARTITION BY {_COLS}) > 1 AS repeated
        FROM line""",
)
def w3(spark: SparkSession, folder: str) -> DataFrame:
    return mark_repeated(line(spark, folder), LINE_FEATURES)


_RULES = [
    between("priority", 1, 5),
    between("priority", 1, 4),
    between("month", 1, 12),
    one_of("region5", 0, 1, 2),
    between("price", 1000, 400000),
    between("acctbal", 0, 10000),
]


def _rule_counts() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{r.column}' AS feature,
                   count(*) FILTER (WHERE NOT ({r.condition.replace('`', '')})) AS invalid,
                   count(*) FILTER (WHERE {r.column} IS NULL) AS nulls FROM prep"""
        for r in _RULES
    )


@query("v1_validity_report", f"WITH {PREP_SQL} {_rule_counts()}")
def v1(spark: SparkSession, folder: str) -> DataFrame:
    return validity_report(prep(spark, folder), _RULES)


def _rule_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT o_orderkey, '{r.column}' AS feature, CAST({r.column} AS DOUBLE) AS value
            FROM prep WHERE NOT ({r.condition.replace('`', '')})"""
        for r in _RULES
    )


@query("v2_invalid_rows", f"WITH {PREP_SQL} {_rule_rows()}")
def v2(spark: SparkSession, folder: str) -> DataFrame:
    return invalid_rows(prep(spark, folder), _RULES, "o_orderkey")
