"""Scores of predictions. Every measure is derived from one confusion table, so the
predictions are computed and read once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.functions.prefix import BUCKET_ROWS, bucket_limits, running_totals, with_buckets
from rowsmith.session import written


def confusion(pred: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, label, prediction, n)."""
    return pred.groupBy(
        *by, F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


BINARY = ("tp", "fp", "tn", "fn", "accuracy", "precision", "recall", "f1")


def all_metrics(
    pred: DataFrame,
    label: str,
    prediction: str = "prediction",
    positive: float = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per group with the counts and measures of the positive class, and the same
    measures averaged over classes by their share of the labels (``weighted_*``)."""
    cells = confusion(pred, label, prediction, by).filter("label IS NOT NULL AND prediction IS NOT NULL")
    hit = F.col("label") == F.col("prediction")
    none = F.lit(0).cast("long")
    # Each cell speaks for two classes: the one it belongs to and the one it was given.
    roles = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("actual"),
            none.alias("predicted"),
            F.when(hit, F.col("n")).otherwise(none).alias("right"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            none.alias("actual"),
            F.col("n").alias("predicted"),
            none.alias("right"),
        ),
    )
    per_class = (
        cells.select(*by, F.inline(roles))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "right")])
        .withColumn("p", _ratio(F.col("right"), F.col("predicted")))
        .withColumn("r", _ratio(F.col("right"), F.col("actual")))
        .withColumn("f", _f1(F.col("p"), F.col("r")))
    )
    total = F.sum("actual")
    mine = F.col("class") == float(positive)

    def of_positive(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(mine, value)), F.lit(0))

    def averaged(name: str) -> Column:
        return F.sum(F.col(name) * F.col("actual")) / total

    tp = of_positive(F.col("right"))
    fp = of_positive(F.col("predicted") - F.col("right"))
    fn = of_positive(F.col("actual") - F.col("right"))
    return per_class.groupBy(*by).agg(
        tp.alias("tp"),
        fp.alias("fp"),
        (total - tp - fp - fn).alias("tn"),
        fn.alias("fn"),
        (F.sum("right") / total).alias("accuracy"),
        of_positive(F.col("p")).cast("double").alias("precision"),
        of_positive(F.col("r")).cast("double").alias("recall"),
        of_positive(F.col("f")).cast("double").alias("f1"),
        averaged("f").alias("weighted_f1"),
        averaged("r").alias("weighted_recall"),
        averaged("p").alias("weighted_precision"),
    )


def classification_metrics(
    pred: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """One row (*by, accuracy, f1, weighted_recall, weighted_precision) over all classes."""
    found = all_metrics(pred, label, prediction, 1, by)
    return found.select(
        *by, "accuracy", F.col("weighted_f1").alias("f1"), "weighted_recall", "weighted_precision"
    )


def binary_metrics(
    pred: DataFrame,
    label: str,
    prediction: str = "prediction",
    positive: float = 1,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row (*by, tp, fp, tn, fn, accuracy, precision, recall, f1) for one class of two."""
    return all_metrics(pred, label, prediction, positive, by).select(*by, *BINARY)


def auc_roc(
    scored: DataFrame,
    label: str,
    score: str,
    positive: float = 1,
    rows_per_bucket: int = BUCKET_ROWS,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per group (*by, auc, positives, negatives): the exact area under the ROC curve, where a
    tie between a positive and a negative counts half. Null unless both classes occur.

    One pass counts the rows of every score of every group; all else reads those counts. Null
    scores and labels are left out, a null in ``by`` is a group of its own.
    """
    groups = {f"__by{i}": F.col(c) for i, c in enumerate(by)}
    rows = scored.select(
        *[c.alias(name) for name, c in groups.items()],
        F.to_json(F.struct(*[F.col(c) for c in by]), {"ignoreNullFields": "false"}).alias("column") if by else F.lit("").alias("column"),
        F.col(score).cast("double").alias("value"),
        (F.col(label) == positive).cast("int").alias("hit"),
    ).dropna(subset=["value", "hit"])
    counts = rows.groupBy("column", *groups, "value").agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg"))
    per_score = written(counts, "score-counts")
    limits = bucket_limits(per_score, rows_per_bucket)
    ranked = running_totals(with_buckets(per_score, limits), ["neg"], limits)
    won = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)
    totals = ranked.groupBy(*groups).agg(
        F.sum(won).alias("won"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )
    return totals.select(
        *[F.col(name).alias(c) for name, c in zip(groups, by)],
        F.when(
            (F.col("positives") > 0) & (F.col("negatives") > 0),
            F.col("won") / F.col("positives") / F.col("negatives"),
        ).alias("auc"),
        "positives",
        "negatives",
    )


def audit_scores(
    scores: DataFrame, positives: Column | str, total: Column | str, tolerance: float = 1e-6
) -> DataFrame:
    """Add whether a row's scores can come from one confusion table of ``total`` rows with
    ``positives`` positives: ``f1_ok`` checks f1 = 2pr / (p + r), ``tp_ok`` that recall gives
    a whole number of hits, and ``consistent`` both and that the accuracy follows."""
    p = F.col(positives) if isinstance(positives, str) else positives
    n = F.col(total) if isinstance(total, str) else total
    precision, recall = F.col("precision"), F.col("recall")
    hits = recall * p
    tp = F.round(hits)
    claimed = _ratio(tp, precision)
    fp = F.round(claimed - tp)
    correct = tp + (n - p - fp)
    return scores.withColumns(
        {
            "f1_ok": F.abs(F.col("f1") - _f1(precision, recall)) <= tolerance,
            "tp_ok": F.abs(hits - tp) <= tolerance * F.greatest(p, F.lit(1)),
            "consistent": (F.abs(F.col("f1") - _f1(precision, recall)) <= tolerance)
            & (F.abs(hits - tp) <= tolerance * F.greatest(p, F.lit(1)))
            & (F.abs(F.col("accuracy") - correct / n) <= tolerance),
        }
    )
