"""Projections, filters, derived columns, vectors and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

# Which survey answers make up each composite feature.
HEALTH_COMPOSITES = {
    "Diet": "Fruits + Veggies",
    "cardiovascular": "HighChol + HighBP + HeartDiseaseorAttack",
    "unhealthy_behavior": "Smoker + HvyAlcoholConsump",
    "healthcare": "AnyHealthcare + (1 - NoDocbcCost)",
}


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name the columns by position."""
    return df.toDF(*names)


def filter_class(df: DataFrame, label: str, value: object) -> DataFrame:
    return df.filter(F.col(label) == value)


def filter_not(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that fail the predicate; rows where it is null are in neither part."""
    return df.filter(~predicate)


def split_xy(df: DataFrame, label: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Features and label as two frames; with ``key`` both carry it, so they can be rejoined."""
    keys = [key] if key else []
    features = [c for c in df.columns if c != label and c not in keys]
    return df.select(*keys, *features), df.select(*keys, label)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique increasing number per row. Not consecutive, and tied to the partitioning:
    use it to tell rows apart, never to match two frames."""
    return df.withColumn(name, F.monotonically_increasing_id())


def assemble(
    df: DataFrame, inputs: Sequence[str], out: str = "features", invalid: str = "error"
) -> DataFrame:
    """Numeric columns into one vector. ``invalid`` is error, skip or keep (NaN) for nulls."""
    return VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid=invalid).transform(df)


def composite_features(df: DataFrame, spec: Mapping[str, str] = HEALTH_COMPOSITES) -> DataFrame:
    """Add columns computed from others, given as name -> SQL expression."""
    return df.withColumns({name: F.expr(text) for name, text in spec.items()})


def union_classes(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both frames, duplicates kept, columns matched by name."""
    return first.unionByName(second)
