"""Feature tables cut from the given tables, each as a DataFrame and as the SQL of a CTE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowsmith.operators.align import align
from rowsmith.operators.metrics import binary_metrics
from rowsmith.sources.score_store import SCORE_COLUMNS
from rowsmith.sources.tables import load_table

# Order facts with a key that is unique; label 1 is a finished order.
PREP_FEATURES = ["price", "month", "priority", "acctbal", "region5"]
PREP_SQL = """
prep AS (
  SELECT o_orderkey, o_totalprice AS price, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, c_acctbal AS acctbal,
         CAST(c_nationkey % 5 AS INTEGER) AS region5,
         CAST(o_orderstatus = 'F' AS INTEGER) AS label
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def _order_label() -> Column:
    return (F.col("o_orderstatus") == "F").cast("int").alias("label")


def prep(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    customer = load_table(spark, folder, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        F.month("o_orderdate").alias("month"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("c_acctbal").alias("acctbal"),
        (F.col("c_nationkey") % 5).cast("int").alias("region5"),
        _order_label(),
    )


# The label side alone: one row per order.
LABEL_SQL = """
outcome AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders)
"""


def outcome(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "orders").select("o_orderkey", _order_label())


# Coded rows without a key: many copies and contradictions.
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
LINE_SQL = """
line AS (
  SELECT l_quantity, l_discount, l_tax, l_linenumber,
         CAST(l_returnflag = 'R' AS INTEGER) AS label
  FROM lineitem)
"""


def line(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "lineitem").select(
        *LINE_FEATURES, (F.col("l_returnflag") == "R").cast("int").alias("label")
    )


# Text statistics of labelled documents; the label can be learned from them.
DOC_FEATURES = ["n_chars", "words", "distinct_words", "distinct_share", "digits", "punctuation", "punctuation_share"]


def doc(spark: SparkSession, folder: str) -> DataFrame:
    words = F.split("text", " ")
    stats = load_table(spark, folder, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("words"),
        F.size(F.array_distinct(words)).cast("double").alias("distinct_words"),
        F.regexp_count("text", F.lit("[0-9]")).cast("double").alias("digits"),
        F.regexp_count("text", F.lit("[^\\w\\s]")).cast("double").alias("punctuation"),
    )
    labels = load_table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    return (
        align(stats, labels, "doc_id")
        .withColumn("distinct_share", F.col("distinct_words") / F.col("words"))
        .withColumn("punctuation_share", F.col("punctuation") / F.greatest("n_chars", F.lit(1.0)))
    )


# Vectors, opened into all of their dimensions.
EMB_DIMS = [f"e{i}" for i in range(1, 65)]


def emb(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load_table(spark, folder, "embeddings")
    parts = [F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate(EMB_DIMS)]
    return vectors.select("vec_id", "label", *parts)


# One row per vector and dimension.
EMB_LONG_SQL = """
emb_long AS (SELECT vec_id, unnest(range(1, 65)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
"""


# Predictions without a model: one judgement taken as a forecast of the other.
PRED_SQL = """
pred AS (SELECT doc_id, toxic AS label, 1 - quality AS prediction FROM labels)
"""


def pred(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "labels").select(
        "doc_id", F.col("toxic").alias("label"), (1 - F.col("quality")).alias("prediction")
    )


# Scores of three fixed forecasts of a return, per line status and line number.
SCORE_MODELS = ["by_discount", "by_quantity", "by_tax"]
SCORE_SAMPLINGS = ["F", "O"]
SCORES_SQL = """
forecast AS (
  SELECT l_linestatus AS sampling, 'line_' || l_linenumber AS feature_set,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         unnest(['by_quantity', 'by_discount', 'by_tax']) AS model,
         unnest([CAST(l_quantity > 25 AS INTEGER), CAST(l_discount > 0.05 AS INTEGER),
                 CAST(l_tax > 0.04 AS INTEGER)]) AS prediction
  FROM lineitem),
tally AS (
  SELECT sampling, feature_set, model,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn
  FROM forecast GROUP BY ALL),
measured AS (
  SELECT *, (tp + tn) / (tp + fp + tn + fn) AS accuracy,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall
  FROM tally),
scores AS (
  SELECT sampling, feature_set, model, accuracy, precision, recall,
         CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
              ELSE 0 END AS f1,
         (tp + fp + tn + fn) / 1000 AS seconds, tp, fp, tn, fn
  FROM measured)
"""


def scores(spark: SparkSession, folder: str, counts: bool = False) -> DataFrame:
    rows = load_table(spark, folder, "lineitem")
    forecasts = F.array(
        *[
            F.struct(F.lit(name).alias("model"), guess.cast("int").alias("prediction"))
            for name, guess in {
                "by_quantity": F.col("l_quantity") > 25,
                "by_discount": F.col("l_discount") > 0.05,
                "by_tax": F.col("l_tax") > 0.04,
            }.items()
        ]
    )
    forecast = rows.select(
        F.col("l_linestatus").alias("sampling"),
        F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")).alias("feature_set"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.inline(forecasts),
    )
    measured = binary_metrics(forecast, "label", by=["sampling", "feature_set", "model"])
    found = measured.withColumn(
        "seconds", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")) / 1000
    ).withColumn(
        "best_params",
        F.create_map(F.lit("positives"), (F.col("tp") + F.col("fn")).cast("string")),
    )
    extra = ["tp", "fp", "tn", "fn"] if counts else []
    return found.select(*SCORE_COLUMNS, *extra)
