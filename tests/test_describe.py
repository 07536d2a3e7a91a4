import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from rowsmith.operators import describe
from rowsmith.operators.describe import class_ratio, density, histogram, value_limits


def bins_of(df, column):
    return [r["n"] for r in df.orderBy("bin").collect() if r["column"] == column]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1000, 1000, allow_nan=False).map(lambda v: round(v, 2)), min_size=2, max_size=60))
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = bins_of(histogram(df, ["x"], 10), "x")
    if min(values) == max(values):
        assert found == [len(values)]
    else:
        edges = np.linspace(min(values), max(values), 11)
        assert found == list(np.histogram(values, edges)[0])


def test_histogram_of_codes_nulls_and_constants(spark):
    df = spark.createDataFrame([(1, 7, None), (2, 7, None), (None, 7, None)], "a int, b int, c int")
    found = histogram(df, ["a", "b", "c"], 4)
    assert bins_of(found, "a") == [1, 0, 0, 1]
    assert bins_of(found, "b") == [3]
    assert bins_of(found, "c") == []


def brute_density(values, grid, bins):
    v = np.asarray(values, float)
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), grid)
    d = np.exp(-0.5 * ((x[:, None] - v[None, :]) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
    return x, d, d * len(v) * (v.max() - v.min()) / bins


@pytest.mark.parametrize("values", [[1, 1, 1, 2, 3, 3, 3, 3, 8] * 5, [i * 1.37 % 11 for i in range(60)]])
def test_density_equals_brute_force(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(3)
    rows = density(df, "x", grid=50, bins=10).orderBy("point").collect()
    x, d, scaled = brute_density(values, 50, 10)
    assert np.allclose([r["x"] for r in rows], x)
    assert np.allclose([r["density"] for r in rows], d)
    assert np.allclose([r["scaled"] for r in rows], scaled)


def test_density_in_cells_is_close(spark):
    values = [float(i * i % 997) for i in range(997)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = density(df, "x", grid=40, prebin=2000).orderBy("point").collect()
    assert np.allclose([r["density"] for r in rows], brute_density(values, 40, 30)[1], rtol=1e-2)


def test_density_needs_spread(spark):
    with pytest.raises(ValueError):
        density(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x")


def test_class_ratio(spark):
    def ratio(labels):
        return tuple(class_ratio(spark.createDataFrame([(v,) for v in labels], "label int"), "label").head())

    assert ratio([0, 0, 0, 1]) == (3, 1, pytest.approx(1 / 3))
    assert ratio([0, 1, 1]) == (1, 2, 0.5)
    assert ratio([0, 0]) == (2, 0, None)


def test_value_limits(spark):
    df = spark.createDataFrame([(1.0, 10), (3.0, 20)], "a double, b int")
    assert {tuple(r) for r in value_limits(df, ["a", "b"], pad_abs=1).collect()} == {
        ("a", 0.0, 4.0),
        ("b", 9.0, 21.0),
    }
    low, high = value_limits(df, ["b"], pad_rel=0.05).select("low", "high").head()
    assert (low, high) == (pytest.approx(9.5), pytest.approx(21.0))


def test_relative_padding_holds_negative_limits(spark):
    from rowsmith.operators.describe import value_limits

    row = value_limits(spark.createDataFrame([(-100.0,), (-50.0,)], "v double"), ["v"], pad_rel=0.05).head()
    assert (row["low"], row["high"]) == (-105.0, -47.5)


def test_densities_leave_out_constant_columns(spark):
    from rowsmith.operators.describe import densities

    rows = spark.range(50).selectExpr("cast(id as double) a", "1 b", "cast(null as double) c")
    found = densities(rows, ["a", "b", "c"], grid=10)
    assert {r["column"] for r in found.collect()} == {"a"} and found.count() == 10
    assert densities(rows, ["b"]).collect() == []


@pytest.mark.parametrize("kind", ["plain", "tail", "codes", "two"])
def test_density_is_within_its_bound(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "plain": rng.normal(1e6, 3, 4_000),
        "tail": np.append(rng.exponential(1, 4_000), [1e4, -2e4]),
        "codes": rng.integers(0, 5, 3_000).astype(float),
        "two": np.array([0.0] * 5 + [1e-9]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    found = {r["point"]: r for r in describe.density(df, "v", grid=97).collect()}
    width = values.std(ddof=1) * len(values) ** -0.2
    assert sorted(found) == list(range(97)) and describe.transform_error() < 1e-13
    for r in found.values():
        exact = np.exp(-0.5 * ((r["x"] - values) / width) ** 2).sum()
        scale = 1 / (len(values) * width * math.sqrt(2 * math.pi))
        # The bound, and what doubles lose in x - value at this size.
        assert abs(r["density"] / scale - exact) <= len(values) * (describe.transform_error() + 1e-15 * abs(values).max() / width)


def test_density_keeps_a_row_per_cell(spark):
    df = spark.range(100_000).select((F.randn(1)).alias("v"))
    plan = describe.density(df, "v", grid=500)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan or "Generate" in plan
    assert plan.count("sum(") < 60  # no aggregate of one sum per grid point
