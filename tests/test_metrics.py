import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from rowsmith.operators.metrics import (
    all_metrics,
    audit_scores,
    auc_roc,
    binary_metrics,
    classification_metrics,
    confusion,
)

SEVEN = [(0, 0)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(1, 1)]


@pytest.fixture(scope="module")
def seven(spark):
    return spark.createDataFrame([(float(a), float(b)) for a, b in SEVEN], "label double, prediction double")


def test_seven_rows(seven):
    row = binary_metrics(seven, "label").head()
    assert (row["tp"], row["fp"], row["tn"], row["fn"]) == (1, 1, 3, 2)
    assert row["accuracy"] == pytest.approx(4 / 7)
    assert (row["recall"], row["precision"], row["f1"]) == (pytest.approx(1 / 3), 0.5, pytest.approx(0.4))
    weighted = classification_metrics(seven, "label").head()
    assert weighted["weighted_recall"] == pytest.approx(weighted["accuracy"])
    assert confusion(seven, "label", "prediction").count() == 4


def test_measures_equal_ml(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b)) for a, b in rng.integers(0, 4, (300, 2))]
    df = spark.createDataFrame(rows, "label double, prediction double").repartition(4)
    mine = classification_metrics(df, "label").head()
    names = {"accuracy": "accuracy", "f1": "f1", "weightedRecall": "weighted_recall", "weightedPrecision": "weighted_precision"}
    for theirs, ours in names.items():
        assert mine[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=1e-9)
    one = all_metrics(df, "label", positive=2).head()
    for theirs, ours in {"recallByLabel": "recall", "precisionByLabel": "precision", "fMeasureByLabel": "f1"}.items():
        judge = MulticlassClassificationEvaluator(metricName=theirs, metricLabel=2.0)
        assert one[ours] == pytest.approx(judge.evaluate(df), abs=1e-9)


def test_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 1.0)], "label double, prediction double")
    row = binary_metrics(df, "label").head()
    assert (row["tp"], row["fn"], row["precision"], row["recall"], row["f1"]) == (0, 1, 0.0, 0.0, 0.0)


def brute_auc(labels, scores):
    wins = [
        (p > n) + (p == n) / 2
        for p, a in zip(scores, labels) if a == 1
        for n, b in zip(scores, labels) if b == 0
    ]
    return float(np.mean(wins))


@pytest.mark.parametrize("rows_per_bucket", [5, 10**6])
@pytest.mark.parametrize("digits", [1, 6])
def test_auc(spark, rows_per_bucket, digits):
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, 200)
    scores = np.round(rng.random(200) + labels * 0.3, digits)
    df = spark.createDataFrame([(int(a), float(s)) for a, s in zip(labels, scores)], "label int, score double")
    found = auc_roc(df.repartition(3), "label", "score", rows_per_bucket=rows_per_bucket).head()
    assert found["auc"] == pytest.approx(brute_auc(labels, scores))
    ml = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert found["auc"] == pytest.approx(ml)
    assert found["positives"] + found["negatives"] == 200


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double")
    assert auc_roc(df, "label", "score").head()["auc"] is None


def test_audit(spark):
    tp, fp, tn, fn = 30, 20, 140, 10
    p, r = tp / (tp + fp), tp / (tp + fn)
    good = ("good", (tp + tn) / 200, p, r, 2 * p * r / (p + r))
    rows = [good, ("f1", *good[1:4], 0.9), ("tp", good[1], p, 0.7512, good[4]), ("acc", 0.5, *good[2:])]
    df = spark.createDataFrame(rows, "name string, accuracy double, precision double, recall double, f1 double")
    found = {r["name"]: r for r in audit_scores(df, F.lit(40), F.lit(200)).collect()}
    assert found["good"]["consistent"]
    assert not found["f1"]["f1_ok"] and not found["tp"]["tp_ok"] and not found["acc"]["consistent"]
    assert found["acc"]["f1_ok"] and found["acc"]["tp_ok"]
