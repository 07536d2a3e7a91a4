"""Fitting, tuning and whole experiments.

Naive Bayes has a closed form, which the SQL recomputes. The other models are gates: the
query checks in Spark what must hold, the SQL gives the rows expected when it does.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from rowsmith.functions.expressions import tidy
from rowsmith.operators.columns import assemble
from rowsmith.operators.metrics import all_metrics, audit_scores, auc_roc
from rowsmith.operators.resample import kfold, oversample, train_test_split
from rowsmith.operators.train import (
    MODEL_KEYS,
    TUNED_VALUES,
    cross_validate,
    experiment,
    fit_score,
    grid_search,
    make_model,
    param_grid,
)
from rowsmith.plans.catalog_resample import hash_sql
from rowsmith.plans.inputs import PREP_SQL, doc, prep
from rowsmith.plans.registry import query
from rowsmith.session import scratch_path
from rowsmith.sources.score_store import SCORE_KEYS, read_trials

_CODES = ["month", "priority", "region5"]
# Text statistics in comparable, non-negative units.
_TEXT = ["log_chars", "log_words", "log_distinct", "distinct_share", "punctuation_share", "log_digits"]


def _codes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = assemble(prep(spark, folder).select("o_orderkey", *_CODES, "label"), _CODES)
    return train_test_split(rows, "o_orderkey")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return doc(spark, folder).select(
        "doc_id",
        F.log1p("n_chars").alias("log_chars"),
        F.log1p("words").alias("log_words"),
        F.log1p("distinct_words").alias("log_distinct"),
        "distinct_share",
        "punctuation_share",
        F.log1p("digits").alias("log_digits"),
        F.col("quality").alias("label"),
    )


def _sums(*cols: str) -> str:
    return ", ".join(f"sum({c}) AS s_{c}" for c in cols)


_IN_TRAIN = f"{hash_sql('o_orderkey', 1234)} < 0.8 * 4294967296"
_BAYES_SQL = f"""
WITH {PREP_SQL}, train AS (SELECT * FROM prep WHERE {_IN_TRAIN}),
test AS (SELECT * FROM prep WHERE NOT ({_IN_TRAIN})),
per_class AS (SELECT label AS class, count(*) AS rows_, {_sums(*_CODES)} FROM train GROUP BY label),
model AS (
  SELECT class, ln(rows_ + 1) - ln((SELECT count(*) FROM train) + 2) AS prior,
         {', '.join(f"ln(s_{c} + 1) - ln({' + '.join('s_' + x for x in _CODES)} + {len(_CODES)}) AS t_{c}" for c in _CODES)}
  FROM per_class),
guess AS (
  SELECT o_orderkey, label,
         max_by(class, prior + {' + '.join(f'{c} * t_{c}' for c in _CODES)}) AS prediction
  FROM test, model GROUP BY ALL)
"""


@query("t5_naive_bayes", f"{_BAYES_SQL} SELECT o_orderkey, label, CAST(prediction AS DOUBLE) AS prediction FROM guess")
def t5_bayes(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _codes(spark, folder)
    model = make_model("nb", "label", len(_CODES)).fit(train)
    return model.transform(test).select("o_orderkey", "label", "prediction")


@query(
    "t1_fit_score",
    f"""{_BAYES_SQL}, tally AS (
          SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
                 count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
                 count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM guess)
        SELECT tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn), 6) + 0.0 AS accuracy,
               CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) ELSE 0 END + 0.0 AS precision,
               CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) ELSE 0 END + 0.0 AS recall,
               CASE WHEN tp > 0 THEN round(2 * tp / (2 * tp + fp + fn), 6) ELSE 0 END + 0.0 AS f1
        FROM tally""",
)
def t1(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _codes(spark, folder)
    found = fit_score(make_model("nb", "label", len(_CODES)), train, test, "label")
    return found.select(
        "tp", "fp", "tn", "fn", *[tidy(m).alias(m) for m in ("accuracy", "precision", "recall", "f1")]
    )


_HELD_OUT = f"(SELECT count(*) FROM labels WHERE NOT ({hash_sql('doc_id', 1234)} < 0.8 * 4294967296))"


def _expected(rows: list[str], columns: str) -> str:
    return f"SELECT {columns} FROM (VALUES " + ", ".join(f"({r})" for r in rows) + ") AS v"


@query(
    "t2_grid_search",
    """SELECT CAST(2 AS BIGINT) AS points, true AS in_range, true AS best_is_highest,
              true AS held_out_well""",
)
def t2(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: an average per grid point, the best one chosen, and a good hold-out AUC."""
    train, test = train_test_split(_texts(spark, folder), "doc_id")
    model = make_model("lr", "label", len(_TEXT))
    grid = param_grid(model, TUNED_VALUES["lr"])
    found = grid_search(model, grid, assemble(train, _TEXT), "label", key="doc_id")
    points = [(a, found.points[i] == found.best_params) for i, a in enumerate(found.averages)]
    averages = spark.createDataFrame(points, "average double, chosen boolean")
    gate = averages.agg(
        F.count(F.lit(1)).alias("points"),
        F.min(F.col("average").between(0, 1)).alias("in_range"),
        (F.max("average") == F.max(F.when(F.col("chosen"), F.col("average")))).alias("best_is_highest"),
    )
    scored = found.model.transform(assemble(test, _TEXT))
    auc = auc_roc(_with_score(scored), "label", "score").select("auc").scalar()
    return gate.withColumn("held_out_well", auc > 0.8)


_FOLD = f"{hash_sql('o_orderkey', 1234)} % 3"
_SMOOTHINGS = TUNED_VALUES["nb"]["smoothing"]


def _fold_auc_sql(smoothing: float) -> str:
    """AUC of Naive Bayes on every fold, fitted on the others, by its closed form and by ranks."""
    terms = [f"ln(s_{c} + {smoothing}) - ln({' + '.join('s_' + x for x in _CODES)} + {len(_CODES) * smoothing}) AS t_{c}" for c in _CODES]
    weight = " + ".join(f"{c} * (b.t_{c} - a.t_{c})" for c in _CODES)
    return f"""
    SELECT fold, CAST({smoothing} AS DOUBLE) AS smoothing,
           round((sum(r) FILTER (WHERE label = 1) - any_value(p) * (any_value(p) + 1) / 2) / any_value(p) / any_value(n), 6) + 0.0 AS auc,
           any_value(p) AS positives, any_value(n) AS negatives
    FROM (
      SELECT fold, label, count(*) FILTER (WHERE label = 1) OVER (PARTITION BY fold) AS p,
             count(*) FILTER (WHERE label = 0) OVER (PARTITION BY fold) AS n,
             rank() OVER (PARTITION BY fold ORDER BY score) + (count(*) OVER (PARTITION BY fold, score) - 1) / 2 AS r
      FROM (
        SELECT f.fold, f.label, {weight} AS score
        FROM folds f
        JOIN (SELECT fold, {', '.join(terms)} FROM others WHERE label = 0) a ON a.fold = f.fold
        JOIN (SELECT fold, {', '.join(terms)} FROM others WHERE label = 1) b ON b.fold = f.fold))
    GROUP BY fold"""


@query(
    "t2_exact_auc",
    f"""WITH {PREP_SQL}, folds AS (SELECT *, CAST({_FOLD} AS INTEGER) AS fold FROM prep WHERE {_IN_TRAIN}),
    others AS (SELECT g.fold, label, {_sums(*_CODES)}
               FROM (SELECT DISTINCT fold FROM folds) g JOIN folds f ON f.fold <> g.fold GROUP BY g.fold, label)
    {' UNION ALL '.join(map(_fold_auc_sql, _SMOOTHINGS))}""",
)
def t2_auc(spark: SparkSession, folder: str) -> DataFrame:
    """The exact AUC of every grid point of Naive Bayes on every fold."""
    train, _ = _codes(spark, folder)
    model = make_model("nb", "label", len(_CODES))
    grid = param_grid(model, TUNED_VALUES["nb"])
    rows = kfold(train, "o_orderkey").select("features", "label", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = cross_validate(model, grid, rows, "label", 3)
    finally:
        rows.unpersist()
    smoothing = F.element_at(F.array(*[F.lit(v) for v in _SMOOTHINGS]), F.col("point") + 1)
    return found.select("fold", smoothing.alias("smoothing"), tidy("auc").alias("auc"), "positives", "negatives")


_TUNED = {key: TUNED_VALUES[key] for key in ("dt", "nb")}


@query(
    "t2_grid_search_orders",
    f"""WITH {PREP_SQL}, held AS (SELECT count(*) AS held_out FROM prep WHERE NOT ({_IN_TRAIN}))
        SELECT model, points, held_out, true AS in_range, true AS best_is_highest
        FROM held, (VALUES ('dt', CAST(4 AS BIGINT)), ('nb', 2)) AS v(model, points)""",
)
def t2_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: two models tuned by three-fold cross-validation on all orders."""
    features = ["price", *_CODES]
    rows = assemble(prep(spark, folder), features).select("o_orderkey", "features", "label")
    train, test = train_test_split(rows, "o_orderkey")
    found = []
    for key, values in _TUNED.items():
        model = make_model(key, "label", len(features))
        tuned = grid_search(model, param_grid(model, values), train, "label", key="o_orderkey")
        row = all_metrics(tuned.model.transform(test), "label").head()
        best = tuned.averages[tuned.points.index(tuned.best_params)]
        found.append(
            (
                key,
                len(tuned.averages),
                row["tp"] + row["fp"] + row["tn"] + row["fn"],
                all(0 <= a <= 1 for a in tuned.averages),
                best == max(tuned.averages),
            )
        )
    return spark.createDataFrame(
        found, "model string, points bigint, held_out bigint, in_range boolean, best_is_highest boolean"
    )


@query(
    "t3_best_params",
    """SELECT 'maxDepth' AS name, true AS from_grid UNION ALL SELECT 'minInstancesPerNode', true""",
)
def t3(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: the best settings name the grid's parameters, with values out of the grid, and
    the refitted model has them."""
    train, _ = train_test_split(_texts(spark, folder), "doc_id")
    model = make_model("dt", "label", len(_TEXT))
    values = TUNED_VALUES["dt"]
    found = grid_search(model, param_grid(model, values), assemble(train, _TEXT), "label", key="doc_id")
    refitted = found.model.bestModel
    rows = [
        (name, value in values[name] and refitted.getOrDefault(name) == value)
        for name, value in found.best_params.items()
    ]
    return spark.createDataFrame(rows, "name string, from_grid boolean")


@query(
    "t4_mlp_grid",
    _expected(["'[6, 50, 2]'", "'[6, 100, 2]'", "'[6, 25, 25, 2]'"], "col0 AS layers, true AS scored"),
)
def t4(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: every layer plan of the network's grid is fitted and gets an average."""
    train, _ = train_test_split(_texts(spark, folder), "doc_id")
    model = make_model("mlp", "label", len(_TEXT))
    grid = param_grid(model, {}, len(_TEXT))
    found = grid_search(model, grid, assemble(train, _TEXT), "label", key="doc_id")
    rows = [(str(p["layers"]), 0 <= a <= 1) for p, a in zip(found.points, found.averages)]
    return spark.createDataFrame(rows, "layers string, scored boolean")


@query("t4_step_size", _expected(["0.01, 'gd'", "0.1, 'gd'"], "CAST(col0 AS DOUBLE) AS step, col1 AS solver, true AS scored"))
def t4_step(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: with step sizes in the grid the network is fitted by the solver that heeds them."""
    train, _ = train_test_split(_texts(spark, folder), "doc_id")
    model = make_model("mlp", "label", len(_TEXT))
    found = grid_search(model, param_grid(model, {"stepSize": [0.01, 0.1]}), assemble(train, _TEXT), "label", key="doc_id")
    rows = [(float(p["stepSize"]), p["solver"], 0 <= a <= 1) for p, a in zip(found.points, found.averages)]
    return spark.createDataFrame(rows, "step double, solver string, scored boolean")


def _with_score(scored: DataFrame) -> DataFrame:
    """The score of class 1: its probability, or the raw margin where a model has none."""
    vector = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.withColumn("score", F.element_at(vector_to_array(vector), 2))


@query(
    "t5_classifiers",
    _expected(
        [f"'{key}'" for key in sorted(MODEL_KEYS)],
        f"col0 AS model, {_HELD_OUT} AS held_out, true AS above_chance, true AS both_classes",
    ),
)
def t5(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: each of the seven models, trained on balanced rows, scores every held-out row,
    ranks good documents above others better than chance, and predicts both classes."""
    train, test = train_test_split(assemble(_texts(spark, folder), _TEXT), "doc_id")
    train = oversample(train, "label", "doc_id")
    train = train.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    test = test.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    try:
        for key in MODEL_KEYS:
            scored = make_model(key, "label", len(_TEXT)).fit(train).transform(test)
            counts = all_metrics(scored, "label").head()
            held_out = counts["tp"] + counts["fp"] + counts["tn"] + counts["fn"]
            both = counts["tp"] + counts["fp"] > 0 and counts["tn"] + counts["fn"] > 0
            auc = auc_roc(_with_score(scored), "label", "score").head()["auc"]
            rows.append((key, held_out, auc > 0.6, both))
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(
        rows, "model string, held_out bigint, above_chance boolean, both_classes boolean"
    )


# Two feature sets: all text statistics, and those of length alone.
_SETS = {"text": _TEXT, "length": ["log_chars", "log_words", "log_distinct"]}
_STRATEGIES = ("down", "ub", "up")
_QUICK = ("dt", "nb")


def _runs_sql(models: tuple[str, ...]) -> str:
    runs = [f"'{s}', '{f}', '{m}'" for s in _STRATEGIES for f in _SETS for m in models]
    return _expected(runs, "col0 AS sampling, col1 AS feature_set, col2 AS model, true AS timed, true AS consistent")


def _experiments(
    spark: SparkSession, folder: str, models: tuple[str, ...], search: bool | str, sets: dict | None = None
) -> DataFrame:
    rows = _texts(spark, folder).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _, test = train_test_split(rows, "doc_id")
        size = test.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("p")).head()
        path = scratch_path(spark, "score-table")
        found = experiment(rows, "doc_id", "label", sets or _SETS, models=models, path=path, search=search)
    finally:
        rows.unpersist()
    audited = audit_scores(found, F.lit(size["p"]), F.lit(size["n"]))
    shown = audited.select("sampling", "feature_set", "model", (F.col("seconds") > 0).alias("timed"), "consistent")
    if search != "halving":
        return shown
    # Rounds, points tried in all rounds, and whether each round kept the better points for the next.
    trials = read_trials(spark, path)
    later = trials.select(*SCORE_KEYS, (F.col("turn") - 1).alias("turn"), "point", F.lit(True).alias("kept"))
    judged = trials.join(later, [*SCORE_KEYS, "turn", "point"], "left").groupBy(*SCORE_KEYS, "turn").agg(
        F.count(F.lit(1)).alias("points"),
        F.min(F.when(F.col("kept"), F.col("average"))).alias("worst_kept"),
        F.max(F.when(F.col("kept").isNull(), F.col("average"))).alias("best_dropped"),
    )
    rounds = judged.groupBy(*SCORE_KEYS).agg(
        F.count(F.lit(1)).alias("rounds"),
        F.sum("points").alias("trials"),
        F.min(F.coalesce(F.col("worst_kept") >= F.col("best_dropped"), F.lit(True))).alias("better_kept"),
    )
    return shown.join(rounds, list(SCORE_KEYS))


@query("t6_experiment", _runs_sql(tuple(MODEL_KEYS)))
def t6(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: all seven models over two feature sets and three samplings. One stored row per planned
    experiment, timed, and with scores that one confusion table of the hold-out can give."""
    return _experiments(spark, folder, tuple(MODEL_KEYS), search=False)


# Points of each model's grid, and what halving makes of them: (rounds, trials).
_HALVING = {2: (1, 2), 3: (2, 5), 4: (2, 6)}
_GRID_POINTS = {"lr": 2, "dt": 4, "rf": 4, "gbt": 2, "nb": 2, "svm": 2, "mlp": 3}
_HALVING_RUNS = [(s, m, *_HALVING[_GRID_POINTS[m]]) for s in _STRATEGIES for m in MODEL_KEYS]


@query(
    "t6_experiment_halving",
    _expected(
        [f"'{s}', '{m}', {r}, {t}" for s, m, r, t in _HALVING_RUNS],
        "col0 AS sampling, 'text' AS feature_set, col1 AS model, true AS timed, true AS consistent, "
        "CAST(col2 AS BIGINT) AS rounds, CAST(col3 AS BIGINT) AS trials, true AS better_kept",
    ),
)
def t6_halving(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: all seven models tuned over their full grids by successive halving, for three samplings. Each run is stored,
    timed and consistent, its rounds are stored too, and every round kept the better points."""
    return _experiments(spark, folder, tuple(MODEL_KEYS), "halving", {"text": _TEXT})


@query("t6_experiment_tuned", _runs_sql(_QUICK))
def t6_tuned(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every model tuned by three-fold cross-validation, for the two that fit fast."""
    return _experiments(spark, folder, _QUICK, search=True)
