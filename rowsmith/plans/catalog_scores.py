"""Score tables: reading, storing, comparing. The scores are measured on the order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from rowsmith.functions.expressions import tidy
from rowsmith.operators.align import pending
from rowsmith.operators.describe import value_limits
from rowsmith.operators.scores import best_model, compare_models, compare_samplings, run_pending
from rowsmith.plans.inputs import SCORE_MODELS, SCORE_SAMPLINGS, SCORES_SQL, scores
from rowsmith.plans.registry import query
from rowsmith.session import scratch_path
from rowsmith.sources.score_store import (
    MEASURES,
    SCORE_KEYS,
    append_scores,
    broken_documents,
    read_scores,
    write_scores_json,
)

_MEASURES_SQL = ", ".join(f"round({m}, 6) + 0.0 AS {m}" for m in (*MEASURES, "seconds"))
_TIDY_SQL = f"""
SELECT sampling, feature_set, model, {_MEASURES_SQL}, CAST(tp + fn AS VARCHAR) AS positives FROM scores
"""


def _shown(found: DataFrame) -> DataFrame:
    return found.select(
        *SCORE_KEYS,
        *[tidy(m).alias(m) for m in (*MEASURES, "seconds")],
        F.col("best_params")["positives"].alias("positives"),
    )


@query("s4_read_scores", f"WITH {SCORES_SQL} {_TIDY_SQL}")
def s4(spark: SparkSession, folder: str) -> DataFrame:
    """The scores as nested JSON documents and back."""
    path = write_scores_json(scores(spark, folder), scratch_path(spark, "score-documents"))
    return _shown(read_scores(spark, f"{path}/*/*", sampling_pattern="sampling=([^/]+)/"))


@query(
    "s4_broken_documents",
    f"""WITH {SCORES_SQL} SELECT sampling, count(*) AS experiments, CAST(1 AS BIGINT) AS broken,
        true AS named FROM scores GROUP BY sampling""",
)
def s4_broken(spark: SparkSession, folder: str) -> DataFrame:
    """A store of one document per sampling and one that is cut short: the others are read, the
    broken one is named."""
    path = write_scores_json(scores(spark, folder), scratch_path(spark, "score-documents"))
    cut = spark.createDataFrame([('{"line_1": {"by_tax": {"accuracy": 0.5, ',)], "value string")
    cut.coalesce(1).write.text(f"{path}/sampling=broken")
    files = f"{path}/*/part-*"
    bad = broken_documents(spark, files).agg(
        F.count(F.lit(1)).alias("broken"), F.every(F.contains("file", F.lit("sampling=broken"))).alias("named")
    )
    read = read_scores(spark, files, sampling_pattern="sampling=([^/]+)/", mode="drop")
    counts = read.groupBy("sampling").agg(F.count(F.lit(1)).alias("experiments"))
    row = bad.head()
    return counts.withColumn("broken", F.lit(row["broken"]).cast("long")).withColumn("named", F.lit(row["named"]))


@query("s5_append_scores", f"WITH {SCORES_SQL} {_TIDY_SQL}")
def s5(spark: SparkSession, folder: str) -> DataFrame:
    """Stored in two batches; the second repeats stored keys with worse scores, which must
    not replace the first."""
    found, path = scores(spark, folder), scratch_path(spark, "score-table")
    append_scores(found.filter(F.col("sampling") == SCORE_SAMPLINGS[0]), path)
    second = found.withColumn(
        "accuracy",
        F.when(F.col("sampling") == SCORE_SAMPLINGS[0], F.lit(0.0)).otherwise(F.col("accuracy")),
    )
    return _shown(append_scores(second, path))


_STORED_SQL = "stored AS (SELECT * FROM scores WHERE sampling = 'F' AND model <> 'by_tax')"


def _stored(found: DataFrame) -> DataFrame:
    return found.filter((F.col("sampling") == "F") & (F.col("model") != "by_tax"))


@query(
    "j4_pending",
    f"""WITH {SCORES_SQL}, {_STORED_SQL}
        SELECT sampling, feature_set, model FROM scores ANTI JOIN stored USING (sampling, feature_set, model)""",
)
def j4(spark: SparkSession, folder: str) -> DataFrame:
    found = scores(spark, folder)
    return pending(found.select(*SCORE_KEYS), _stored(found), SCORE_KEYS)


@query(
    "r1_run_pending",
    f"WITH {SCORES_SQL} {_TIDY_SQL}",
)
def r1(spark: SparkSession, folder: str) -> DataFrame:
    """A plan of all experiments of which a third is stored: the others run, and the stored ones,
    whose rerun would fail, are left alone."""
    found = scores(spark, folder).persist(StorageLevel.MEMORY_AND_DISK)
    path = scratch_path(spark, "score-table")

    def run(sampling: str, feature_set: str, model: str) -> DataFrame:
        if sampling == "F" and model != "by_tax":
            raise AssertionError("a stored experiment ran again")
        mine = (F.col("sampling") == sampling) & (F.col("feature_set") == feature_set) & (F.col("model") == model)
        return found.filter(mine)

    try:
        append_scores(_stored(found), path)
        return _shown(run_pending(found.select(*SCORE_KEYS), path, run))
    finally:
        found.unpersist()


def _pivot_sql(rows: str, pivot: str, names: list[str]) -> str:
    columns = ", ".join(
        f"round(max(value) FILTER (WHERE {pivot} = '{n}'), 6) + 0.0 AS \"{n}\"" for n in names
    )
    return f"""WITH {SCORES_SQL}, long AS (
      UNPIVOT (SELECT sampling, feature_set, model, accuracy, CAST(precision AS DOUBLE) AS precision,
                      CAST(recall AS DOUBLE) AS recall, CAST(f1 AS DOUBLE) AS f1 FROM scores)
      ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)
    SELECT {rows}, {columns} FROM long GROUP BY {rows}"""


@query("r2_compare_models", _pivot_sql("sampling, feature_set, metric", "model", SCORE_MODELS))
def r2(spark: SparkSession, folder: str) -> DataFrame:
    wide = compare_models(scores(spark, folder), SCORE_MODELS)
    return wide.select("sampling", "feature_set", "metric", *[tidy(m).alias(m) for m in SCORE_MODELS])


@query("r3_compare_samplings", _pivot_sql("metric, feature_set, model", "sampling", SCORE_SAMPLINGS))
def r3(spark: SparkSession, folder: str) -> DataFrame:
    wide = compare_samplings(scores(spark, folder), SCORE_SAMPLINGS)
    return wide.select("metric", "feature_set", "model", *[tidy(s).alias(s) for s in SCORE_SAMPLINGS])


@query(
    "o3_best_model",
    f"""WITH {SCORES_SQL}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY sampling, feature_set ORDER BY accuracy DESC, model) AS turn
          FROM scores)
        SELECT sampling, feature_set, model, round(accuracy, 6) + 0.0 AS accuracy FROM ranked WHERE turn = 1""",
)
def o3(spark: SparkSession, folder: str) -> DataFrame:
    return best_model(scores(spark, folder), "accuracy").withColumn("accuracy", tidy("accuracy"))


@query(
    "a11_value_limits_scores",
    f"WITH {SCORES_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS "column", round(min({m}) * 0.95, 6) + 0.0 AS low,
            round(max({m}) * 1.05, 6) + 0.0 AS high FROM scores"""
        for m in MEASURES
    ),
)
def a11(spark: SparkSession, folder: str) -> DataFrame:
    found = value_limits(scores(spark, folder), MEASURES, pad_rel=0.05)
    return found.select("column", tidy("low").alias("low"), tidy("high").alias("high"))
