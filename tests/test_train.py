import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.sql import functions as F

from rowsmith.operators import train as train_module
from rowsmith.operators.columns import assemble
from rowsmith.operators.resample import kfold, train_test_split
from rowsmith.operators.train import (
    MODEL_KEYS,
    TUNED_VALUES,
    ExactAuc,
    cross_validate,
    experiment,
    first_trees,
    fit_score,
    grid_search,
    halving_search,
    make_model,
    mlp_layers,
    param_grid,
    split_and_resample,
)
from rowsmith.session import scratch_path
from rowsmith.sources.score_store import read_trials

FEATURES = ["x", "y"]


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(600).select(
        F.col("id").alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 10).alias("x"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 10).alias("y"),
    ).withColumn("label", (F.col("x") > 7).cast("int"))


@pytest.fixture(scope="module")
def parts(data):
    return train_test_split(assemble(data, FEATURES), "k")


def test_layers_and_grids(spark):
    assert mlp_layers(13) == [[13, 50, 2], [13, 100, 2], [13, 25, 25, 2]]
    assert set(TUNED_VALUES) == set(MODEL_KEYS)
    model = make_model("mlp", "label", 4)
    grid = param_grid(model, {"stepSize": [0.01, 0.1]}, 4)
    assert len(grid) == 6 and {tuple(p[model.layers]) for p in grid} == {(4, 50, 2), (4, 100, 2), (4, 25, 25, 2)}
    assert param_grid(make_model("lr", "label", 4), {}, 4) == [{}]
    with pytest.raises(ValueError):
        make_model("knn", "label", 4)


@pytest.mark.parametrize("key", MODEL_KEYS)
def test_models_fit_and_score(parts, key):
    row = fit_score(make_model(key, "label", 2), *parts, "label").head()
    assert row["tp"] + row["fp"] + row["tn"] + row["fn"] == parts[1].count()
    assert row["weighted_recall"] == pytest.approx(row["accuracy"])
    if key in ("dt", "rf", "gbt", "lr"):
        assert row["accuracy"] > 0.9


def test_grid_search_picks_the_best(parts):
    model = make_model("dt", "label", 2)
    grid = param_grid(model, {"maxDepth": [0, 3]})
    found = grid_search(model, grid, parts[0], "label", key="k")
    assert len(found.averages) == 2 and found.best_params == {"maxDepth": 3}
    assert found.model.bestModel.getOrDefault("maxDepth") == 3
    again = grid_search(model, grid, parts[0].repartition(3), "label", key="k")
    assert again.averages == pytest.approx(found.averages, abs=0.02)
    assert not parts[0].is_cached


def test_averages_are_exact(parts):
    """Against the area by pairs, of models fitted one by one."""
    rows = kfold(parts[0], "k", 3)
    model = make_model("dt", "label", 2)
    grid = param_grid(model, {"maxDepth": [1, 2]})
    found = {(r["fold"], r["point"]): r["auc"] for r in cross_validate(model, grid, rows, "label", 3).collect()}
    for (fold, point), auc in found.items():
        scored = model.fit(rows.filter(F.col("fold") != fold), grid[point]).transform(rows.filter(F.col("fold") == fold))
        got = [(r["label"], r["probability"][1]) for r in scored.collect()]
        pairs = [(x > y) + (x == y) / 2 for a, x in got if a == 1 for b, y in got if b == 0]
        assert auc == pytest.approx(sum(pairs) / len(pairs))
        assert ExactAuc("label").evaluate(scored) == pytest.approx(auc)
    assert len(found) == 6


def test_halving_finds_what_grid_search_finds(spark, parts):
    model = make_model("dt", "label", 2)
    grid = param_grid(model, {"maxDepth": [0, 1, 3], "minInstancesPerNode": [1, 200]})
    full = grid_search(model, grid, parts[0], "label", key="k")
    halved = halving_search(model, grid, parts[0], "label", "k")
    assert halved.best_params == full.best_params
    best = halved.points.index(halved.best_params)
    assert halved.shares[best] == max(halved.shares)
    # With enough rows of both classes each round reads a larger share, for fewer points.
    many = assemble(spark.range(6_000).selectExpr("id k", "double(id % 17) x", "double(id % 5) y", "int(id % 17 > 9) label"), FEATURES)
    large = halving_search(model, grid, many, "label", "k")
    assert sorted(large.shares) == pytest.approx([1 / 6] * 3 + [1 / 3, 1 / 2, 1 / 2])
    assert large.best_params == grid_search(model, grid, many, "label", key="k").best_params
    assert halved.model.bestModel.getOrDefault("maxDepth") == full.best_params["maxDepth"]
    alone = halving_search(model, grid[:1], parts[0], "label", "k")
    assert alone.best_params == alone.points[0]


def test_halving_goes_on_after_a_break(parts):
    model = make_model("dt", "label", 2)
    grid = param_grid(model, {"maxDepth": [0, 1, 2, 3]})
    stored = {}

    def keep(rows):
        if stored:
            raise RuntimeError("lost")
        stored.update({(turn, point): (share, average) for turn, point, share, average in rows})

    with pytest.raises(RuntimeError):
        halving_search(model, grid, parts[0], "label", "k", store=keep)
    rounds = []
    found = halving_search(model, grid, parts[0], "label", "k", known=stored, store=rounds.append)
    assert [r[0][0] for r in rounds] == [1]  # the first round is not run again
    assert found.averages == halving_search(model, grid, parts[0], "label", "k").averages


def test_rounds_are_stored_beside_the_scores(spark, data):
    path = scratch_path(spark, "table")
    arguments = dict(
        feature_sets={"both": FEATURES}, samplings=["ub"], models=["dt", "nb"], path=path, search="halving",
        values={"dt": {"maxDepth": [1, 2, 3]}, "nb": {"smoothing": [1.0, 10.0]}}, folds=2,
    )
    found = experiment(data, "k", "label", **arguments)
    assert {r["model"] for r in found.collect()} == {"dt", "nb"}
    trials = read_trials(spark, path).groupBy("model", "turn").count().collect()
    assert sorted(map(tuple, trials)) == [("dt", 0, 3), ("dt", 1, 2), ("nb", 0, 2)]
    other = experiment(data, "k", "label", **{**arguments, "samplings": ["ub", "down"]})
    assert other.count() == 4 and read_trials(spark, path).count() == 14


def test_resampling_leaves_the_hold_out_alone(data):
    _, plain = split_and_resample(data, "k", "label", "ub")
    for sampling in ("down", "up"):
        train, test = split_and_resample(data, "k", "label", sampling)
        assert {r["k"] for r in test.collect()} == {r["k"] for r in plain.collect()}
        counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
        assert counts[0] == pytest.approx(counts[1], rel=0.25)
        assert train.columns == data.columns
    mixed = split_and_resample(data, "k", "label", "up", resample_first=True)
    total = mixed[0].count() + mixed[1].count()
    assert total == 2 * data.filter("label = 0").count()


def test_experiment_is_stored_and_not_repeated(spark, data):
    path = scratch_path(spark, "table")
    arguments = dict(
        feature_sets={"one": ["x"], "both": FEATURES}, samplings=["ub"], models=["dt"], path=path,
        values={"dt": {"maxDepth": [1, 2]}}, folds=2,
    )
    found = experiment(data, "k", "label", **arguments)
    rows = {r["feature_set"]: r for r in found.collect()}
    assert set(rows) == {"one", "both"}
    assert rows["one"]["best_params"]["maxDepth"] in ("1", "2") and rows["one"]["seconds"] > 0
    again = {r["feature_set"]: r["seconds"] for r in experiment(data, "k", "label", **arguments).collect()}
    assert again == {name: r["seconds"] for name, r in rows.items()}


def test_rows_of_an_experiment_are_given_free(spark, data):
    """Samplings that run at the same time score what they score alone, and nothing stays in memory."""
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    arguments = dict(feature_sets={"both": FEATURES}, models=["nb", "dt"], search=False)
    names = ("accuracy", "precision", "recall", "f1")
    found = {
        (r["sampling"], r["model"]): [r[n] for n in names]
        for r in experiment(data, "k", "label", path=scratch_path(spark, "table"), **arguments).collect()
    }
    assert len(found) == 6
    for sampling in ("ub", "down", "up"):
        alone = experiment(data, "k", "label", samplings=[sampling], path=scratch_path(spark, "table"), parallelism=1, **arguments)
        for r in alone.collect():
            assert found[sampling, r["model"]] == [r[n] for n in names]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_boosted_trees_are_fitted_once_for_all_numbers_of_trees(parts, monkeypatch):
    rows = kfold(parts[0], "k", 2)
    model = make_model("gbt", "label", 2)
    grid = param_grid(model, {"maxDepth": [1, 2], "maxIter": [2, 5, 3]})
    counts = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, data, params=None: counts.append(params) or fit(self, data, params))
    found = {(r["fold"], r["point"]): r["auc"] for r in cross_validate(model, grid, rows, "label", 2).collect()}
    assert len(found) == 12 and len(counts) == 4 and all(p[model.maxIter] == 5 for p in counts)
    for fold in range(2):
        train, test = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
        for point, params in enumerate(grid):
            alone = fit(model, train, params)
            assert found[fold, point] == ExactAuc("label").evaluate(alone.transform(test))
    short, long = [fit(model, parts[0], {model.maxIter: n}) for n in (2, 5)]
    cut = first_trees(long, 2)
    assert [t.toDebugString.split("\n", 1)[1] for t in cut.trees] == [t.toDebugString.split("\n", 1)[1] for t in short.trees]
    assert cut.treeWeights == short.treeWeights and cut.getLabelCol() == "label"
    names = ["k", "probability", "prediction"]
    assert sorted(cut.transform(parts[1]).select(names).collect()) == sorted(short.transform(parts[1]).select(names).collect())
    stopped = model.copy({model.validationIndicatorCol: "held"})
    for tried in (stopped, make_model("dt", "label", 2)):
        fitted_apart = param_grid(tried, {"maxDepth": [1, 2]}) if tried is not stopped else grid
        cross = train_module._longest_series(tried, fitted_apart)
        assert cross == list(range(len(fitted_apart)))
    assert train_module._longest_series(model, grid) == [1, 1, 1, 4, 4, 4]


def test_rows_of_an_experiment_do_not_carry_their_source(spark, data, monkeypatch):
    """Every job of a fit sends the way to its rows, so it must start at the written rows, not at their source."""
    seen = []
    fit = DecisionTreeClassifier.fit

    def noted(self, rows, params=None):
        seen.append(rows._jdf.queryExecution().analyzed().toString())
        return fit(self, rows, params)

    monkeypatch.setattr(DecisionTreeClassifier, "fit", noted)
    for search in ("halving", True, False):
        experiment(
            data, "k", "label", {"both": FEATURES}, ["up"], ["dt"], scratch_path(spark, "table"),
            values={"dt": {"maxDepth": [1, 2]}}, folds=2, search=search,
        ).count()
    assert seen and all("parquet" in plan and "Range" not in plan for plan in seen)
