"""Block aggregates: co-moments with gaps, and components of wide vectors."""

import numpy as np
import pandas as pd
import pytest

from rowsmith.functions.moments import block_moments, co_moments, merge_moments
from rowsmith.operators.correlate import correlation_array, pair_counts, pearson_matrix
from rowsmith.operators.wide import fit_wide, vector_moments, wide_components, wide_project

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def gaps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3)) * [1.0, 5.0, 0.1] + [1e6, -3.0, 0.0]
    x[:, 1] += x[:, 0] - 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    frame = pd.DataFrame(x, columns=COLS)
    rows = [tuple(None if np.isnan(v) else float(v) for v in row) for row in x]
    return frame, spark.createDataFrame(rows, "a double, b double, c double").repartition(7)


@pytest.mark.parametrize("cut", [0, 1, 4, 9, 10])
def test_blocks_merge_to_the_whole(cut):
    rng = np.random.default_rng(cut)
    x = rng.normal(size=(10, 4)) + 1e5
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 3] = [np.nan] * 5 + [2.5] * 5
    parts = [block_moments(p) for p in (x[:cut], x[cut:]) if len(p)]
    merged = parts[0] if len(parts) == 1 else merge_moments(*parts)
    for got, want in zip(merged, block_moments(x)):
        assert np.allclose(got, want, rtol=1e-9, atol=1e-9)
    n = int(merged[0][0, 1])
    both = x[~np.isnan(x[:, 0]) & ~np.isnan(x[:, 1])]
    assert n == len(both)
    if n:
        assert np.isclose(merged[4][0, 1], ((both[:, 0] - both[:, 0].mean()) * (both[:, 1] - both[:, 1].mean())).sum())


def test_pairwise_and_listwise_deletion(gaps):
    frame, df = gaps
    assert np.allclose(correlation_array(df, COLS, "pearson", nulls="pairwise"), frame.corr(), atol=1e-9)
    assert np.allclose(correlation_array(df, COLS, "pearson"), frame.dropna().corr(), atol=1e-9)
    counts = pair_counts(df, COLS).toPandas().pivot(index="feature_a", columns="feature_b", values="covariance")
    assert np.allclose(counts.to_numpy(), frame.cov().to_numpy(), rtol=1e-8)
    assert pearson_matrix(df, COLS, nulls="pairwise").columns == ["feature", *COLS]
    for method, nulls in (("spearman", "pairwise"), ("pearson", "some")):
        with pytest.raises(ValueError):
            correlation_array(df, COLS, method, nulls=nulls)


def test_moments_of_odd_tables(spark):
    none = co_moments(spark.createDataFrame([], "a double, b double"), ["a", "b"])
    assert none.n.sum() == 0 and np.isnan(none.correlation()[0, 1]) and np.isnan(none.covariance()).all()
    rows = [(0.1, 1.0, None), (0.1, 2.0, None), (0.1, 4.0, 5.0), (float("nan"), 3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    found = co_moments(df, COLS)
    assert found.n.tolist() == [[3, 3, 1], [3, 4, 1], [1, 1, 1]]
    corr = found.correlation()
    assert np.isnan(corr[0, 1]) and np.isnan(corr[1, 2]) and (np.diag(corr) == 1).all()
    assert pair_counts(spark.createDataFrame([(1.0, None)], "a double, b double"), ["a", "b"]).filter("covariance is null").count() == 4


def vectors(spark, x, parts=5):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(parts)


def exact(x, standardize=False):
    z = x - x.mean(axis=0)
    if standardize:
        z = z / z.std(axis=0, ddof=1)
    _, sizes, turn = np.linalg.svd(z, full_matrices=False)
    return sizes**2 / (len(x) - 1), turn.T


@pytest.mark.parametrize("standardize", [False, True])
def test_leading_components_of_thousands_of_columns(spark, standardize):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 6)) * [9, 7, 5, 3, 2, 1] @ rng.normal(size=(6, 3000)) + rng.normal(size=(120, 3000)) + 50
    values, turn = exact(x, standardize)
    df = vectors(spark, x)
    found = wide_components(df, "v", 4, standardize, tolerance=1e-9).orderBy("component").toPandas()
    assert np.allclose(found["eigenvalue"], values[:4], rtol=1e-8)
    assert np.allclose(found["ratio"], values[:4] / values.sum(), rtol=1e-8)
    loadings = np.stack(found["loadings"])
    assert np.allclose(np.abs((loadings * turn[:, :4].T).sum(axis=1)), 1.0, atol=1e-8)
    assert (found["residual"] <= 1e-9).all()


def test_flat_spectrum_thin_blocks_and_projection(spark):
    x = np.random.default_rng(2).normal(size=(400, 30)) + 3
    values, turn = exact(x)
    df = vectors(spark, x)
    fit = fit_wide(df, "v", 30, width=4)
    assert np.allclose(fit.values, values, rtol=1e-6) and fit.passes <= 9
    scores = np.stack(wide_project(df, "v", 2, tolerance=1e-10).orderBy("id").toPandas()["scores"])
    assert np.allclose(np.abs(scores), np.abs(x @ turn[:, :2]), atol=1e-5)
    with pytest.warns(UserWarning, match="not within"):
        short = fit_wide(df, "v", 3, width=3, max_passes=2)
    assert short.residuals.max() > 1e-6 and (short.values <= values[:3] + 1e-9).all()


def test_vectors_that_are_not_whole(spark):
    x = np.random.default_rng(4).normal(size=(50, 5))
    x[:, 2] = 7.0
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    odd = [(90, None), (91, [1.0, None, 2.0, 3.0, 4.0]), (92, [float("nan")] * 5)]
    df = spark.createDataFrame(rows + odd, "id long, v array<double>")
    n, mean, variance = vector_moments(df, "v")
    assert n == 50 and np.allclose(mean, x.mean(axis=0)) and np.allclose(variance, x.var(axis=0, ddof=1)) and variance[2] == 0
    fit = fit_wide(df, "v", 9, standardize=True)
    assert fit.loadings.shape[1] <= 5 and np.allclose(fit.values[:4], exact(np.delete(x, 2, axis=1), True)[0], rtol=1e-6)
    assert np.allclose(fit.loadings[2, :4], 0.0, atol=1e-8)
    got = {r["id"]: r["scores"] for r in wide_project(df.filter("id < 9 or id = 90"), "v", 2).collect()}
    assert got[90] is None and len(got[0]) == 2
    for bad in (df.limit(0), df.filter("id = 0")):
        with pytest.raises(ValueError, match="two complete"):
            fit_wide(bad, "v", 2)
    mixed = spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        vector_moments(mixed, "v")
