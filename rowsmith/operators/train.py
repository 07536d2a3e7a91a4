"""Classifiers: fitting, grid search, and whole experiments.

The model fits are those of ``pyspark.ml``, which read the training rows in place and send
only model-sized sums to the driver.
"""

from __future__ import annotations

import hashlib
import json
import math
import threading
import time
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from rowsmith.functions.expressions import HASH_RANGE, hash32
from rowsmith.operators.columns import assemble
from rowsmith.operators.metrics import all_metrics, auc_roc
from rowsmith.operators.resample import kfold, no_sampling, oversample, train_test_split, undersample
from rowsmith.operators.scores import run_pending
from rowsmith.session import written
from rowsmith.sources.score_store import SCORE_KEYS, SCORE_SCHEMA, TRIAL_SCHEMA, append_trials, read_trials

TASK_ROWS = 50_000  # rows of a training task
SIDE_BY_SIDE = 14  # experiments at the same time: fits are long series of short jobs, each of which leaves most cores idle
MODEL_KEYS = ("lr", "dt", "rf", "gbt", "nb", "svm", "mlp")
LONGEST = ("gbt", "mlp", "svm", "lr", "rf", "dt", "nb")  # by the number of jobs of a fit


def mlp_layers(features: int, classes: int = 2) -> list[list[int]]:
    """Layer plans for a network, sized by the number of inputs."""
    return [[features, *hidden, classes] for hidden in ([50], [100], [25, 25])]


def make_model(key: str, label: str, features: int, seed: int = 1234) -> Estimator:
    """One of the seven classifiers by its short name, with settings fit for a first run."""
    common = {"labelCol": label, "featuresCol": "features"}
    if key == "lr":
        return LogisticRegression(**common)
    if key == "dt":
        return DecisionTreeClassifier(seed=seed, **common)
    if key == "rf":
        return RandomForestClassifier(seed=seed, **common)
    if key == "gbt":
        return GBTClassifier(seed=seed, **common)
    if key == "nb":
        return NaiveBayes(**common)
    if key == "svm":
        return LinearSVC(regParam=0.01, **common)
    if key == "mlp":
        return MultilayerPerceptronClassifier(seed=seed, layers=mlp_layers(features)[0], **common)
    raise ValueError(f"unknown model: {key}")


# The parameters tuned for each model, with the values known to be tried.
TUNED_VALUES = {
    "lr": {"maxIter": [1000], "regParam": [0.01, 0.1]},
    "dt": {"maxDepth": [5, 10], "minInstancesPerNode": [1, 2]},
    "rf": {"maxDepth": [5, 10], "numTrees": [20, 50]},
    "gbt": {"maxDepth": [5], "maxIter": [50, 100]},
    "nb": {"smoothing": [1.0, 10.0]},
    "svm": {"regParam": [0.01, 0.1]},
    # Layer plans are added by size. A step size is left out: the default solver ignores it.
    "mlp": {},
}


def param_grid(
    model: Estimator, values: Mapping[str, Sequence], features: int | None = None
) -> list[dict]:
    """All combinations of the values; a network also gets its layer plans, and the solver that
    heeds a step size when the values have one."""
    if "stepSize" in values and model.hasParam("solver"):
        # A step size takes effect in plain gradient descent only.
        values = {**values, "solver": ["gd"]}
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(model.getParam(name), list(options))
    if model.hasParam("layers") and "layers" not in values and features is not None:
        builder = builder.addGrid(model.getParam("layers"), mlp_layers(features))
    return builder.build()


def fit_score(model: Estimator, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Fit once and score the held-out rows: one row with all measures."""
    return all_metrics(model.fit(train).transform(test), label)


class ExactAuc(Evaluator):
    """The exact area under the ROC curve as an evaluator for the tuning tools of ``pyspark.ml``, whose own one
    puts the scores into 1,000 bins."""

    def __init__(self, label: str):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        found = auc_roc(with_score(dataset), self.label, SCORE).head()["auc"]
        return float("nan") if found is None else found

    def isLargerBetter(self) -> bool:
        return True


SCORE = "__score"


def with_score(scored: DataFrame, name: str = SCORE, vector: str | None = None) -> DataFrame:
    """Add the score of class 1: its probability, or the raw margin where a model has none."""
    vector = vector or ("probability" if "probability" in scored.columns else "rawPrediction")
    return scored.withColumn(name, F.element_at(vector_to_array(vector), 2))


def _threads(df: DataFrame, parallelism: int | None) -> int:
    return parallelism or min(8, df.sparkSession.sparkContext.defaultParallelism)


def _all_scores(models: Sequence[Model], rows: DataFrame, label: str, keep: Sequence[str]) -> DataFrame:
    """Rows (*keep, label, point, score) of every row under every model, in one pass over the rows."""
    entries, wide = [], rows
    for i, model in enumerate(models):
        names = {p: f"__{p}{i}" for p in ("predictionCol", "rawPredictionCol", "probabilityCol") if model.hasParam(p)}
        named = model.copy({model.getParam(p): name for p, name in names.items()})
        wide = named.transform(wide)
        vector = names.get("probabilityCol", names["rawPredictionCol"])
        entries.append(F.struct(F.lit(i).alias("point"), F.element_at(vector_to_array(vector), 2).alias("score")))
    return wide.select(*keep, label, F.inline(F.array(*entries)))


def _longest_series(model: Estimator, grid: Sequence[dict]) -> list[int]:
    """For each point the one whose fit has its trees too: boosting adds tree after tree, so of points that differ in the
    number of trees alone the longest series starts with all the others. Early stopping makes them differ; other
    models have no such points."""
    own = list(range(len(grid)))
    if not isinstance(model, GBTClassifier) or model.isDefined(model.validationIndicatorCol):
        return own
    if any(model.validationIndicatorCol in point for point in grid):
        return own
    trees = [point.get(model.maxIter, model.getMaxIter()) for point in grid]
    rest = [{p: v for p, v in point.items() if p != model.maxIter} for point in grid]
    return [max((q for q in own if rest[q] == rest[p]), key=lambda q: (trees[q], -q)) for p in own]


def first_trees(fitted: GBTClassificationModel, trees: int) -> GBTClassificationModel:
    """The model of the first trees of a boosted one: what a fit of so many iterations gives. It is meant for scores;
    it does not know its number of features, on which importances hang."""
    gateway = SparkSession.active().sparkContext._gateway
    models, inner = gateway.jvm.org.apache.spark.ml, fitted._java_obj
    kept = gateway.new_array(models.regression.DecisionTreeRegressionModel, trees)
    weights = gateway.new_array(gateway.jvm.double, trees)
    for i, (tree, weight) in enumerate(zip(inner.trees()[:trees], fitted.treeWeights[:trees])):
        kept[i], weights[i] = tree, weight
    java = models.classification.GBTClassificationModel(inner.uid(), kept, weights)
    return fitted._copyValues(GBTClassificationModel(java), {fitted.maxIter: trees})


def cross_validate(
    model: Estimator, grid: Sequence[dict], rows: DataFrame, label: str, folds: int, parallelism: int | None = None
) -> DataFrame:
    """Rows (fold, point, auc, positives, negatives): the exact AUC of every grid point on every fold.

    ``rows`` has a column ``fold``. The fits run side by side; the scores of all folds and points then go through one
    grouped aggregate. A fold of one class gives null. Boosted trees are fitted once for all numbers of trees.
    """
    source = _longest_series(model, grid)
    jobs = [(f, p) for f in range(folds) for p in sorted(set(source))]
    parts = [rows.filter(F.col("fold") != f) for f in range(folds)]

    def fit(job: tuple[int, int]) -> Model:
        return model.fit(parts[job[0]], grid[job[1]])

    with ThreadPool(min(_threads(rows, parallelism), len(jobs))) as pool:
        fitted = dict(zip(jobs, pool.map(inheritable_thread_target(rows.sparkSession)(fit), jobs)))
    for f in range(folds):
        for p, q in enumerate(source):
            if p != q:
                fitted[f, p] = first_trees(fitted[f, q], grid[p].get(model.maxIter, model.getMaxIter()))
    held = [
        _all_scores([fitted[f, p] for p in range(len(grid))], rows.filter(F.col("fold") == f), label, ["fold"])
        for f in range(folds)
    ]
    return auc_roc(reduce(DataFrame.unionByName, held), label, "score", by=["fold", "point"])


def _averages(found: DataFrame, points: int) -> list[float]:
    """Mean AUC of each grid point over the folds that have one; NaN if none has. Folds x points rows are collected."""
    values: dict[int, list[float]] = {p: [] for p in range(points)}
    for row in found.filter(F.col("auc").isNotNull()).orderBy("point", "fold").collect():
        values[row["point"]].append(row["auc"])
    return [sum(v) / len(v) if v else float("nan") for v in values.values()]


def _best_first(averages: Mapping[int, float]) -> list[int]:
    """Points by falling average, the earlier in the grid first; those without an average last."""
    return sorted(averages, key=lambda p: (math.isnan(averages[p]), -averages[p] if averages[p] == averages[p] else 0.0, p))


@dataclass(frozen=True)
class GridResult:
    """A cross-validated model, the mean metric of each grid point, and the best settings.

    ``shares`` has the share of the rows on which each point's mean was last taken.
    """

    model: CrossValidatorModel
    points: list[dict[str, object]]
    averages: list[float]
    best_params: dict[str, object]
    shares: list[float] = field(default_factory=list)


def _named(grid: Sequence[dict]) -> list[dict[str, object]]:
    return [{p.name: v for p, v in point.items()} for point in grid]


def grid_search(
    model: Estimator,
    grid: Sequence[dict],
    train: DataFrame,
    label: str,
    folds: int = 3,
    key: str | None = None,
    metric: str = "areaUnderROC",
    parallelism: int | None = None,
    seed: int = 1234,
) -> GridResult:
    """Try every grid point by cross-validation and refit the best on all training rows.

    With ``key`` the folds come from its hash, so they do not depend on the partitioning. The area under the ROC curve is
    exact; other metrics are those of Spark's evaluator.
    The rows are kept for the many fits and given free afterwards, unless the caller keeps them.
    """
    rows = kfold(train, key, folds, seed, "fold") if key is not None else train.withColumn("fold", (F.rand(seed) * folds).cast("int"))
    rows = rows.select("features", label, "fold").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if metric == "areaUnderROC":
            averages = _averages(cross_validate(model, grid, rows, label, folds, parallelism), len(grid))
            best = _best_first(dict(enumerate(averages)))[0]
            found = CrossValidatorModel(model.fit(rows, grid[best]), averages, [], [])
        else:
            evaluator = BinaryClassificationEvaluator(labelCol=label, metricName=metric)
            validator = CrossValidator(
                estimator=model, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=folds,
                parallelism=_threads(train, parallelism), seed=seed, foldCol="fold",
            )
            found = validator.fit(rows)
            averages = [float(v) for v in found.avgMetrics]
            better = max if evaluator.isLargerBetter() else min
            best = averages.index(better(averages))
    finally:
        rows.unpersist()
    points = _named(grid)
    return GridResult(found, points, averages, points[best], [1.0] * len(points))


MIN_CLASS_ROWS = 10  # of each class in each fold, before a share of the rows may decide
SHARE_SEED = 77


def _enough(rows: DataFrame, label: str, folds: int, shares: Sequence[float]) -> float:
    """The first share in which every fold has ``MIN_CLASS_ROWS`` rows of both classes, else 1. One pass for all shares."""
    counts = rows.groupBy("fold", label).agg(*[F.count_if(F.col("at") < s).alias(f"n{i}") for i, s in enumerate(shares)])
    found = counts.collect()  # a row per fold and class
    for i, share in enumerate(shares):
        if len(found) >= 2 * folds and all(r[f"n{i}"] >= MIN_CLASS_ROWS for r in found):
            return share
    return 1.0


def halving_search(
    model: Estimator,
    grid: Sequence[dict],
    train: DataFrame,
    label: str,
    key: str,
    folds: int = 3,
    factor: int = 2,
    parallelism: int | None = None,
    seed: int = 1234,
    known: Mapping[tuple[int, int], tuple[float, float]] | None = None,
    store: Callable[[list[tuple[int, int, float, float]]], None] | None = None,
) -> GridResult:
    """Grid search by successive halving: each round cross-validates the points that are left on one share of the
    rows, keeps the better 1 / ``factor`` of them, and gives these a larger share, until one is left.

    With n points left a round reads 1/n of the rows, so all rounds cost the same: a grid of n points takes about
    log(n) fits of all rows in place of n. Shares are taken by the key's hash, so each holds the one before, copies of a row stay
    together, and nothing is shuffled. A share grows until every fold has ``MIN_CLASS_ROWS`` rows of both classes.

    ``store`` is given the rows (round, point, share, average) of each round that is over; what it stored comes back as ``known``,
    (round, point) -> (share, average), and these rounds are not run again.
    """
    known = known or {}
    rows = kfold(train, key, folds, seed, "fold").withColumn("at", hash32(key, SHARE_SEED) / float(HASH_RANGE))
    rows = rows.select("features", label, "fold", "at").persist(StorageLevel.MEMORY_AND_DISK)
    alive = list(range(len(grid)))
    averages, shares = [float("nan")] * len(grid), [0.0] * len(grid)
    try:
        turn = 0
        while len(alive) > 1:
            if not all((turn, p) in known for p in alive):
                first = max(1.0 / len(alive), *[shares[p] for p in alive])
                share = _enough(rows, label, folds, [min(1.0, first * factor**i) for i in range(1 + math.ceil(math.log(len(alive), factor)))])
                part = rows if share >= 1 else rows.filter(F.col("at") < share)
                found = _averages(cross_validate(model, [grid[p] for p in alive], part, label, folds, parallelism), len(alive))
                known = {**known, **{(turn, p): (share, a) for p, a in zip(alive, found)}}
                if store is not None:
                    store([(turn, p, share, a) for p, a in zip(alive, found)])
            for p in alive:
                shares[p], averages[p] = known[turn, p]
            alive = _best_first({p: averages[p] for p in alive})[: -(-len(alive) // factor)]
            turn += 1
        found = CrossValidatorModel(model.fit(rows, grid[alive[0]]), averages, [], [])
    finally:
        rows.unpersist()
    points = _named(grid)
    return GridResult(found, points, averages, points[alive[0]], shares)


def experiment_plan(
    spark: SparkSession, samplings: Sequence[str], feature_sets: Sequence[str], models: Sequence[str]
) -> DataFrame:
    """Rows (sampling, feature_set, model), one per experiment."""
    rows = [(s, f, m) for s in samplings for f in feature_sets for m in models]
    return spark.createDataFrame(rows, "sampling string, feature_set string, model string")


SAMPLINGS: dict[str, Callable[[DataFrame, str, str], DataFrame]] = {
    "ub": lambda df, label, key: no_sampling(df),
    "down": lambda df, label, key: undersample(df, label, key),
    "up": lambda df, label, key: oversample(df, label, key).drop("copy"),
}


def split_and_resample(
    df: DataFrame, key: str, label: str, sampling: str, resample_first: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Training and hold-out rows of one sampling strategy.

    By default only the training side is resampled, so the hold-out keeps the true class
    shares and no copy of a training row. ``resample_first`` resamples everything first.
    """
    change = SAMPLINGS[sampling]
    if resample_first and sampling == "up":
        # Copies are split one by one, as in the published order: a row can be on both sides.
        rows = oversample(df, label, key).withColumn("__copy", F.concat_ws("#", F.col(key).cast("string"), "copy"))
        train, test = train_test_split(rows, "__copy")
        return train.drop("copy", "__copy"), test.drop("copy", "__copy")
    if resample_first:
        return train_test_split(change(df, label, key), key)
    train, test = train_test_split(df, key)
    return change(train, label, key), test


def experiment(
    df: DataFrame,
    key: str,
    label: str,
    feature_sets: Mapping[str, Sequence[str]],
    samplings: Sequence[str] = ("ub", "down", "up"),
    models: Sequence[str] = MODEL_KEYS,
    path: str = "",
    values: Mapping[str, Mapping[str, Sequence]] | None = None,
    resample_first: bool = False,
    search: bool | str = True,
    folds: int = 3,
    parallelism: int | None = None,
) -> DataFrame:
    """Score every sampling x feature set x model and keep the results in the table at
    ``path``, from which experiments that are already there are not run again.

    ``search`` is ``"halving"`` (:func:`halving_search`, whose rounds are stored beside the scores and are not
    run again either), ``True`` or ``"grid"`` (:func:`grid_search`), or ``False``: each model is fitted once with its own settings.
    """
    spark = df.sparkSession
    tuned = values or TUNED_VALUES
    size = df.count()

    # The rows of one sampling and feature set are prepared once for all its models, and given free when none of them runs
    # and a later one has begun. Experiments start in this order, so rows are only prepared again if two starts overtake each other.
    ready: dict[tuple[str, str], list[DataFrame]] = {}
    running: Counter[tuple[str, str]] = Counter()
    turn = threading.Lock()

    def release(but: tuple[str, str] | None = None) -> None:
        for name in [n for n in ready if n != but and not running[n]]:
            for frame in ready.pop(name):
                frame.unpersist()

    @contextmanager
    def prepared(sampling: str, feature_set: str) -> Iterator[list[DataFrame]]:
        name = (sampling, feature_set)
        with turn:
            if name not in ready:
                # Fits are long series of short jobs: no more tasks than the rows are worth. Every job and task carries the
                # whole way from the source to its rows, so they are written, and kept once: by the search if there is one.
                tasks = 1 + size * (2 if sampling == "up" else 1) // TASK_ROWS
                parts = [
                    written(assemble(part, feature_sets[feature_set]).select(key, "features", label).coalesce(tasks), "experiment-rows").coalesce(tasks)
                    for part in split_and_resample(df, key, label, sampling, resample_first)
                ]
                ready[name] = parts if search else [part.persist(StorageLevel.MEMORY_AND_DISK) for part in parts]
            running[name] += 1
        try:
            yield ready[name]
        finally:
            with turn:
                running[name] -= 1
                release(but=next(reversed(ready)))

    def rounds_of(experiment_key: tuple[str, str, str], grid: Sequence[dict], features: Sequence[str]) -> dict:
        """What :func:`halving_search` needs to go on after a break and to be gone on with."""
        told = json.dumps([_named(grid), list(features), folds, key, label, resample_first], sort_keys=True, default=str)
        plan = hashlib.md5(told.encode()).hexdigest()
        mine = read_trials(spark, path).filter(F.col("plan") == plan)
        for name, value in zip(SCORE_KEYS, experiment_key):
            mine = mine.filter(F.col(name) == value)
        known = {(r["turn"], r["point"]): (r["share"], r["average"]) for r in mine.collect()}

        def store(rows: list[tuple[int, int, float, float]]) -> None:
            append_trials(spark.createDataFrame([(*experiment_key, plan, *r) for r in rows], TRIAL_SCHEMA), path)

        return {"known": known, "store": store}

    def run(sampling: str, feature_set: str, model_key: str) -> DataFrame:
        with prepared(sampling, feature_set) as (train, test):
            return fitted(sampling, feature_set, model_key, train, test)

    def fitted(sampling: str, feature_set: str, model_key: str, train: DataFrame, test: DataFrame) -> DataFrame:
        features = list(feature_sets[feature_set])
        model = make_model(model_key, label, len(features))
        started = time.monotonic()
        best: dict[str, object] = {}
        if search:
            grid = param_grid(model, tuned.get(model_key, {}), len(features))
            if search == "halving":
                state = rounds_of((sampling, feature_set, model_key), grid, features)
                found = halving_search(model, grid, train, label, key, folds, parallelism=parallelism, **state)
            else:
                found = grid_search(model, grid, train, label, folds, key, parallelism=parallelism)
            scored, best = found.model.transform(test), found.best_params
        else:
            scored = model.fit(train).transform(test)
        row = all_metrics(scored, label).head()
        seconds = time.monotonic() - started
        values_row = (
            sampling, feature_set, model_key,
            row["accuracy"], row["precision"], row["recall"], row["f1"],
            seconds, {name: str(value) for name, value in best.items()},
        )
        return spark.createDataFrame([values_row], SCORE_SCHEMA)

    try:
        plan = experiment_plan(spark, samplings, list(feature_sets), models)
        return run_pending(plan, path, run, side_by_side=parallelism or SIDE_BY_SIDE, longest=LONGEST)
    finally:
        running.clear()
        release()
