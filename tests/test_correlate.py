import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from rowsmith.operators import correlate
from rowsmith.operators.columns import assemble
from rowsmith.operators.correlate import (
    correlation_array,
    correlation_long,
    label_correlation,
    rank_table,
    select_correlated,
    top_correlated,
)

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 400
    frame = pd.DataFrame(
        {
            "a": rng.integers(0, 4, n).astype(float),
            "b": rng.normal(size=n),
            "c": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)),
            "d": rng.integers(0, 2, n).astype(float),
        }
    )
    frame["b"] += frame["a"]
    return frame, spark.createDataFrame(frame).repartition(5)


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_matrix_equals_ml_and_pandas(data, method):
    frame, df = data
    found = correlation_array(df, COLS, method)
    ml = Correlation.corr(assemble(df, COLS), "features", method).head()[0].toArray()
    assert np.allclose(found, ml, atol=1e-9)
    assert np.allclose(found, frame[COLS].corr(method).to_numpy(), atol=1e-9)


def test_matrix_does_not_depend_on_join_or_bucket_choice(data, monkeypatch):
    frame, df = data
    monkeypatch.setattr(correlate, "BROADCAST_VALUES", 10)
    found = correlation_array(df, COLS, "spearman", rows_per_bucket=30)
    assert np.allclose(found, frame[COLS].corr("spearman").to_numpy(), atol=1e-9)


@pytest.mark.parametrize("rows_per_bucket", [7, 10**6])
def test_rank_table(data, rows_per_bucket):
    frame, df = data
    found = rank_table(df, ["b", "c"], rows_per_bucket).toPandas()
    for c in ("b", "c"):
        mine = dict(found[found["column"] == c][["value", "rank"]].to_numpy())
        ranks = frame[c].rank()
        assert all(mine[v] == r for v, r in zip(frame[c], ranks))


@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("label", ["d", "b"])
def test_label_correlation(data, method, label):
    frame, df = data
    features = [c for c in COLS if c != label]
    rows = label_correlation(df, features, label, method, rows_per_bucket=50).orderBy("position").collect()
    expected = frame[COLS].corr(method)[label]
    assert [r["feature"] for r in rows] == features
    assert np.allclose([r["corr"] for r in rows], [expected[f] for f in features], atol=1e-9)


def test_constant_column_and_nulls(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, 1, 0), (2.0, 5.0, 3, 1), (3.0, 5.0, 2, 1), (None, 5.0, 9, 0)],
        "x double, k double, z int, label int",
    )
    for method in ("pearson", "spearman"):
        found = {r["feature"]: r["corr"] for r in label_correlation(df, ["x", "k", "z"], "label", method).collect()}
        assert math.isnan(found["k"])
        assert found["x"] == pytest.approx(math.sqrt(3) / 2)
        best = top_correlated(df, ["k", "x", "z"], "label", 4, method).collect()
        assert {r["feature"] for r in best} == {"x", "z"}
        matrix = correlation_array(df, ["x", "k"], method)
        assert matrix[1][1] == 1.0 and math.isnan(matrix[0][1])


def test_long_form_and_selection(data):
    _, df = data
    long = correlation_long(df, COLS, "pearson")
    assert long.count() == 16
    assert long.filter("feature_a = feature_b").select(F.min("corr")).head()[0] == pytest.approx(1.0)
    names = select_correlated(df, ["b", "c", "d"], "a", 1)
    assert names == ["b", "a"]


def test_unknown_method(data):
    with pytest.raises(ValueError):
        correlation_array(data[1], COLS, "kendall")
    with pytest.raises(ValueError):
        label_correlation(data[1], ["b"], "a", "kendall")


def test_buckets_stay_near_the_limit(spark):
    """90 % equal values, and codes beside a continuous label."""
    from rowsmith.functions.prefix import bucket_limits, value_counts, with_buckets

    rows = spark.range(40_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id").cast("double")).otherwise(0.0).alias("mostly"), F.col("id").alias("wide")
    )
    counts = value_counts(rows, ["mostly", "wide"])
    limits = bucket_limits(counts, 500)
    sizes = with_buckets(counts, limits).groupBy("column", "bucket").count().collect()
    assert max(r["count"] for r in sizes) <= 1_000


def test_spearman_with_codes_and_a_continuous_label(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    data = pd.DataFrame({"code": rng.integers(0, 5, 3_000), "label": rng.normal(size=3_000)})
    data.loc[:1_500, "label"] = 0.0
    data["near"] = data["label"] + rng.normal(size=3_000) * 0.1
    got = {r["feature"]: r["corr"] for r in label_correlation(spark.createDataFrame(data), ["code", "near"], "label", rows_per_bucket=100).collect()}
    ranks = data.rank()
    for c in ("code", "near"):
        assert abs(got[c] - ranks[c].corr(ranks["label"])) < 1e-9


def test_wide_spearman_goes_through_one_long_table(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    from rowsmith.operators import correlate

    monkeypatch.setattr(correlate, "BROADCAST_VALUES", 10)
    rng = np.random.default_rng(4)
    data = pd.DataFrame({f"c{i}": rng.normal(size=400).round(2) for i in range(5)} | {"code": rng.integers(0, 3, 400)})
    found = correlate.correlation_array(spark.createDataFrame(data).repartition(3), list(data.columns))
    assert np.abs(found - data.rank().corr().to_numpy()).max() < 1e-9


def test_limits_of_many_columns_take_a_constant_number_of_scans(spark):
    """64 continuous columns: one job counts them, one sketches them, and placing is one lookup, no union."""
    from rowsmith.functions.prefix import bucket_limits, running_totals, value_counts, with_buckets

    cols = [f"c{i}" for i in range(64)]
    rows = spark.range(400).select(*[F.rand(i).alias(c) if i else (F.col("id") % 3).cast("double").alias(c) for i, c in enumerate(cols)])
    counts = value_counts(rows, cols)
    limits = bucket_limits(counts, rows_per_bucket=50)
    assert limits["c0"] == [] and all(5 <= len(limits[c]) <= 8 for c in cols[1:])
    placed = with_buckets(counts, limits)
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation") == 1
    ranked = running_totals(placed, ["n"], limits)
    for c in ("c0", "c1", "c63"):
        got = [(r["value"], r["before_n"]) for r in ranked.filter(F.col("column") == c).orderBy("value").collect()]
        total, want = 0, []
        for r in counts.filter(F.col("column") == c).orderBy("value").collect():
            want.append((r["value"], total))
            total += r["n"]
        assert got == want


def test_infinite_values_keep_their_order(spark):
    from rowsmith.functions.prefix import bucket_limits, running_totals, value_counts, with_buckets

    values = [float("-inf"), *map(float, range(100)), float("inf"), float("nan")]
    counts = value_counts(spark.createDataFrame([(v,) for v in values], "v double"), ["v"])
    limits = bucket_limits(counts, rows_per_bucket=7)
    ranked = running_totals(with_buckets(counts, limits), ["n"], limits).orderBy("value").collect()
    assert [r["before_n"] for r in ranked] == list(range(103))
