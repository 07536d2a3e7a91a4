"""Cleaning: exact copies, contradictory labels, and value rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.operators.align import with_group_facts


@dataclass(frozen=True)
class Rule:
    """A named condition on one column, as SQL text."""

    column: str
    condition: str

    def holds(self) -> Column:
        return F.expr(self.condition)


def between(column: str, low: float, high: float) -> Rule:
    return Rule(column, f"`{column}` BETWEEN {low} AND {high}")


def one_of(column: str, *values: float) -> Rule:
    return Rule(column, f"`{column}` IN ({', '.join(map(str, values))})")


# The allowed answers of the health survey.
YES_NO_COLUMNS = (
    "HighBP", "HighChol", "CholCheck", "Smoker", "Stroke", "HeartDiseaseorAttack",
    "PhysActivity", "Fruits", "Veggies", "HvyAlcoholConsump", "AnyHealthcare", "NoDocbcCost",
    "DiffWalk", "Sex",
)
ANSWER_RANGES = {
    "GenHlth": (1, 5), "MentHlth": (0, 30), "PhysHlth": (0, 30),
    "Age": (1, 13), "Education": (1, 6), "Income": (1, 8),
}


def health_survey_rules() -> list[Rule]:
    return [one_of(c, 0, 1) for c in YES_NO_COLUMNS] + [
        between(c, low, high) for c, (low, high) in ANSWER_RANGES.items()
    ]


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One copy of every row; nulls equal each other."""
    return df.dropDuplicates()


def _consistent(low: str, high: str, labelled: str, rows: str) -> Column:
    """One label for the whole group, where a null label counts as a value of its own."""
    one_value = (F.col(low) == F.col(high)) & (F.col(labelled) == F.col(rows))
    return F.coalesce(one_value, F.lit(False)) | (F.col(labelled) == 0)


def drop_contradictions(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Drop every row whose features also occur with another label; other columns, such as
    a key, and further copies of a row stay."""
    facts = {
        "__low": F.min(label),
        "__high": F.max(label),
        "__labelled": F.count(label),
        "__n": F.count(F.lit(1)),
    }
    checked = with_group_facts(df, features, facts)
    return checked.filter(_consistent("__low", "__high", "__labelled", "__n")).drop(*facts)


def clean(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Duplicates and contradictions removed by one aggregate, so by one shuffle.

    Equal rows combine before the shuffle, so a row with very many copies costs one row
    per task.
    """
    groups = df.groupBy(*features).agg(
        F.min(label).alias("__low"),
        F.max(label).alias("__high"),
        F.count(label).alias("__labelled"),
        F.count(F.lit(1)).alias("__n"),
    )
    kept = groups.filter(_consistent("__low", "__high", "__labelled", "__n"))
    return kept.select(*features, F.col("__low").alias(label))


def validity_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows (feature, invalid, nulls), all rules in one pass. Nulls are counted apart."""
    columns = list(dict.fromkeys(r.column for r in rules))
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(c).alias(f"__present{i}") for i, c in enumerate(columns)],
        *[F.count_if(~r.holds()).alias(f"__invalid{i}") for i, r in enumerate(rules)],
    )
    entries = [
        F.struct(
            F.lit(r.column).alias("feature"),
            F.col(f"__invalid{i}").alias("invalid"),
            (F.col("__rows") - F.col(f"__present{columns.index(r.column)}")).alias("nulls"),
        )
        for i, r in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*entries)))


def invalid_rows(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """Rows (key, feature, value) behind the report's counts; no shuffle."""
    entries = [
        F.struct(
            F.lit(r.column).alias("feature"),
            F.col(r.column).cast("double").alias("value"),
            (~r.holds()).alias("broken"),
        )
        for r in rules
    ]
    broken = F.filter(F.array(*entries), lambda e: e["broken"])
    return df.select(key, F.inline(broken)).drop("broken")
