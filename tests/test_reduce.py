import numpy as np
import pandas as pd
import pytest

from rowsmith.operators import reduce as reduce_module
from rowsmith.operators.reduce import (
    absolute_contributions,
    choose_by_elbow,
    choose_clusters,
    choose_components,
    explained_variance_table,
    factor_eigenvalues,
    factor_loadings,
    kmeans_clusters,
    kmeans_cost_curve,
    mean_silhouette,
    pca_filter,
    pca_fit,
    pca_project,
    silhouettes,
    top_contributors,
)

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    z = rng.normal(size=(300, 4)) * [5.0, 2.0, 1.0, 0.3]
    z[:, 2] += z[:, 0] * 0.5
    frame = pd.DataFrame(z + 3.0, columns=COLS)
    frame["key"] = range(300)
    return frame, spark.createDataFrame(frame).repartition(4)


def decompose(matrix):
    values, vectors = np.linalg.eigh(matrix)
    return values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("standardize", [False, True])
def test_loadings_and_ratios(data, standardize):
    frame, df = data
    matrix = np.corrcoef(frame[COLS].T) if standardize else np.cov(frame[COLS].T)
    values, vectors = decompose(matrix)
    found = pca_fit(df, COLS, 4, standardize).toPandas()
    loadings = found.pivot(index="feature", columns="component", values="loading").to_numpy()
    assert np.allclose(np.abs(loadings), np.abs(vectors), atol=1e-8)
    ratios = found.drop_duplicates("component").sort_values("component")["ratio"]
    assert np.allclose(ratios, values / values.sum())


def test_projection_is_not_centred(data):
    frame, df = data
    _, vectors = decompose(np.cov(frame[COLS].T))
    expected = frame[COLS].to_numpy() @ vectors[:, :2]
    found = pca_project(df, COLS, 2).orderBy("key").select("pc1", "pc2").toPandas().to_numpy()
    assert np.allclose(np.abs(found), np.abs(expected))


def test_every_feature_competes(data):
    frame, df = data
    order = ["d", "c", "b", "a"]
    _, vectors = decompose(np.cov(frame[order].T))
    sums = np.abs(vectors[:, :2]).sum(axis=1)
    found = absolute_contributions(df, order, 2).orderBy("position").toPandas()
    assert np.allclose(found["contribution"], sums)
    best = [r["feature"] for r in top_contributors(df, order, 2).collect()]
    assert best == [order[i] for i in np.argsort(-sums)[:2]]
    assert best[0] not in order[:2] or best[1] not in order[:2]


def test_variance_table_and_choices(spark, data, monkeypatch):
    frame, df = data
    values, _ = decompose(np.cov(frame[COLS].T))
    shares = values / values.sum()
    table = explained_variance_table(df, COLS).orderBy("component").toPandas()
    assert np.allclose(table["cumulative"], shares.cumsum())
    need = int(np.argmax(shares.cumsum() >= 0.9)) + 1
    assert choose_components(df, COLS, 0.9).head()["components"] == need
    known = spark.createDataFrame(
        [(1, 0.6), (2, 0.2), (3, 0.05), (4, 0.05), (5, 0.05), (6, 0.05)], "component int, ratio double"
    )
    monkeypatch.setattr(reduce_module, "explained_variance_table", lambda *a, **k: known)
    assert choose_by_elbow(df, COLS).head()["components"] == 3


def test_eigenvalues(data):
    frame, df = data
    found = factor_eigenvalues(df, COLS).orderBy("factor").toPandas()
    assert np.allclose(found["eigenvalue"], decompose(np.corrcoef(frame[COLS].T))[0])
    assert list(found["keep"]) == list(found["eigenvalue"] >= 1)


def test_clusters(spark):
    points = [(i, 10.0 * (i % 3) + 0.01 * i, -10.0 * (i % 3)) for i in range(90)]
    df = spark.createDataFrame(points, "key int, x double, y double").repartition(3)
    groups = kmeans_clusters(df, ["x", "y"], 3).toPandas()
    assert groups.groupby(groups["key"] % 3)["cluster"].nunique().tolist() == [1, 1, 1]
    assert groups["cluster"].nunique() == 3
    projected = kmeans_clusters(df, ["x", "y"], 3, components=1)
    assert projected.columns == ["key", "x", "y", "cluster"] and projected.count() == 90
    cost = kmeans_cost_curve(df, ["x", "y"], [2, 3]).orderBy("k").toPandas()["cost"]
    assert cost.iloc[1] < cost.iloc[0] / 10


def test_filter_keeps_composites_that_exist(spark, data):
    _, df = data
    found = pca_filter(df, COLS, 2, {"mix": "a + b", "d": "a * 1000"}, keep=["key"])
    assert found.columns[0] == "key" and found.columns[3:] == ["mix", "d"]
    assert set(found.columns[1:3]) == {"a", "b"}
    assert found.filter("d > 500").count() == 0
    assert pca_filter(df, COLS, 1, None).columns == ["a"]


def test_varimax_finds_simple_structure(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(2_000, 2))
    cols = ["a", "b", "c", "d", "e", "f"]
    noisy = [base[:, i // 3] * 2 + rng.normal(size=2_000) * 0.3 for i in range(6)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*noisy)], ", ".join(f"{c} double" for c in cols))
    rows = factor_loadings(df, cols).collect()
    assert {r["factor"] for r in rows} == {1, 2}
    table = np.array([[next(r["rotated"] for r in rows if (r["feature"], r["factor"]) == (c, f)) for f in (1, 2)] for c in cols])
    assert all(sorted(np.abs(row))[0] < 0.1 and sorted(np.abs(row))[1] > 0.95 for row in table)
    plain = np.array([[next(r["loading"] for r in rows if (r["feature"], r["factor"]) == (c, f)) for f in (1, 2)] for c in cols])
    assert np.allclose(table @ table.T, plain @ plain.T)
    corr = np.corrcoef(np.array(noisy))
    full = factor_loadings(df, cols, 6).collect()
    wide = np.zeros((6, 6))
    for r in full:
        wide[cols.index(r["feature"]), r["factor"] - 1] = r["rotated"]
    assert np.allclose(wide @ wide.T, corr)


def test_silhouettes_match_a_plain_loop(spark):
    rng = np.random.default_rng(4)
    rows = [(int(c), float(x + 3 * c), float(y)) for c, x, y in zip(rng.integers(0, 3, 200), rng.normal(size=200), rng.normal(size=200))]
    df = spark.createDataFrame([*rows, (1, None, 0.0), (None, 1.0, 1.0)], "cluster int, x double, y double").repartition(4)
    at = {c: np.mean([r[1:] for r in rows if r[0] == c], axis=0) for c in range(3)}
    want = {c: [] for c in range(3)}
    for c, x, y in rows:
        far = {k: float(np.hypot(x - m[0], y - m[1])) for k, m in at.items()}
        b = min(d for k, d in far.items() if k != c)
        want[c].append((b - far[c]) / max(b, far[c]))
    got = silhouettes(df, ["x", "y"])
    for r in got.collect():
        assert r["n"] == len(want[r["cluster"]]) and r["silhouette"] == pytest.approx(np.mean(want[r["cluster"]]))
    whole = mean_silhouette(got).head()
    assert whole["clusters"] == 3 and whole["silhouette"] == pytest.approx(np.mean(sum(want.values(), [])))
    one = silhouettes(df.filter("cluster = 1"), ["x", "y"]).collect()
    assert [r["silhouette"] for r in one] == [None]


def test_the_right_number_of_clusters_is_chosen(spark):
    rng = np.random.default_rng(5)
    rows = [(float(x + 20 * (i % 4)), float(y)) for i, (x, y) in enumerate(rng.normal(size=(400, 2)))]
    found = choose_clusters(spark.createDataFrame(rows, "x double, y double"), ["x", "y"], [2, 3, 4, 6]).collect()
    assert [r["k"] for r in found if r["chosen"]] == [4]
