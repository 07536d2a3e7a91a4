"""Scores of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.functions.expressions import tidy
from rowsmith.operators.metrics import audit_scores, auc_roc, binary_metrics, classification_metrics
from rowsmith.plans.inputs import PRED_SQL, SCORES_SQL, pred, scores
from rowsmith.plans.registry import query
from rowsmith.sources.tables import load_table


def _weighted_sql(table: str) -> str:
    return f"""
    total AS (SELECT count(*) AS n FROM {table}),
    classes AS (SELECT label AS class FROM {table} UNION SELECT prediction FROM {table}),
    per_class AS (
      SELECT class, count(*) FILTER (WHERE label = class) AS actual,
             count(*) FILTER (WHERE prediction = class) AS predicted,
             count(*) FILTER (WHERE label = class AND prediction = class) AS hit
      FROM {table}, classes GROUP BY class),
    rates AS (
      SELECT *, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS p,
             CASE WHEN actual > 0 THEN hit / actual ELSE 0 END AS r FROM per_class)
    SELECT round(sum(hit) / any_value(n), 6) + 0.0 AS accuracy,
           round(sum(actual * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / any_value(n), 6) + 0.0 AS f1,
           round(sum(actual * r) / any_value(n), 6) + 0.0 AS weighted_recall,
           round(sum(actual * p) / any_value(n), 6) + 0.0 AS weighted_precision
    FROM rates, total"""


def _rounded(found: DataFrame) -> DataFrame:
    return found.select(
        *[tidy(c).alias(c) if t == "double" else F.col(c) for c, t in found.dtypes]
    )


@query("a12_classification_metrics", f"WITH {PRED_SQL}, {_weighted_sql('pred')}")
def a12(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(classification_metrics(pred(spark, folder), "label"))


_CLASSES_SQL = """
guess AS (
  SELECT CAST(l_linenumber % 3 AS INTEGER) AS label, CAST(l_quantity % 4 AS INTEGER) AS prediction
  FROM lineitem)
"""


@query("a12_classification_metrics_multiclass", f"WITH {_CLASSES_SQL}, {_weighted_sql('guess')}")
def a12_many(spark: SparkSession, folder: str) -> DataFrame:
    """Three true classes, four predicted ones, over all order lines."""
    rows = load_table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") % 3).cast("int").alias("label"),
        (F.col("l_quantity") % 4).cast("int").alias("prediction"),
    )
    return _rounded(classification_metrics(rows, "label"))


@query(
    "a13_binary_metrics",
    f"""WITH {PRED_SQL}, tally AS (
          SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
                 count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
                 count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM pred)
        SELECT tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn), 6) + 0.0 AS accuracy,
               round(tp / (tp + fp), 6) + 0.0 AS precision, round(tp / (tp + fn), 6) + 0.0 AS recall,
               round(2 * tp / (2 * tp + fp + fn), 6) + 0.0 AS f1 FROM tally""",
)
def a13(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(binary_metrics(pred(spark, folder), "label"))


def _auc_sql(source: str) -> str:
    return f"""
    WITH scored AS ({source}),
    ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r
               FROM scored),
    sums AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n,
                    sum(r) FILTER (WHERE label = 1) AS s FROM ranked)
    SELECT round((s - p * (p + 1) / 2) / p / n, 6) + 0.0 AS auc, p AS positives, n AS negatives
    FROM sums"""


@query(
    "a14_auc_roc",
    _auc_sql("SELECT toxic AS label, n_chars AS score FROM labels JOIN documents USING (doc_id)"),
)
def a14(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_table(spark, folder, "labels").join(
        load_table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    return _rounded(auc_roc(rows, "toxic", "n_chars"))


@query(
    "a14_auc_roc_continuous",
    _auc_sql("SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_extendedprice AS score FROM lineitem"),
)
def a14_continuous(spark: SparkSession, folder: str) -> DataFrame:
    """Many distinct scores, through buckets as on data too large for one."""
    rows = load_table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), "l_extendedprice"
    )
    return _rounded(auc_roc(rows, "label", "l_extendedprice", rows_per_bucket=5000))


@query(
    "r4_audit_scores",
    f"""WITH {SCORES_SQL}, claims AS (
          SELECT sampling, feature_set, model, accuracy, precision, recall, tp + fn AS p,
                 tp + fp + tn + fn AS n,
                 CASE WHEN model = 'by_tax' THEN f1 * 1.1 ELSE f1 END AS f1 FROM scores),
        parts AS (SELECT *, round(recall * p) AS hits,
                 CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f
                 FROM claims),
        judged AS (SELECT *, abs(f1 - f) <= 1e-6 AS f1_ok, abs(recall * p - hits) <= 1e-6 * greatest(p, 1) AS tp_ok,
                 abs(accuracy - (hits + n - p - round(CASE WHEN precision > 0 THEN hits / precision ELSE 0 END - hits)) / n)
                   <= 1e-6 AS accuracy_ok FROM parts)
        SELECT sampling, feature_set, model, f1_ok, tp_ok, f1_ok AND tp_ok AND accuracy_ok AS consistent
        FROM judged""",
)
def r4(spark: SparkSession, folder: str) -> DataFrame:
    """One of the three forecasts gets an f1 that its precision and recall cannot give."""
    found = scores(spark, folder, counts=True)
    claimed = found.withColumn(
        "f1", F.when(F.col("model") == "by_tax", F.col("f1") * 1.1).otherwise(F.col("f1"))
    )
    audited = audit_scores(
        claimed, F.col("tp") + F.col("fn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    )
    return audited.select("sampling", "feature_set", "model", "f1_ok", "tp_ok", "consistent")
