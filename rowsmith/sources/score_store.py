"""Experiment scores: nested JSON documents in, a table of committed batches to work on.

A JSON document maps feature set -> model -> measures. Documents are read whole, one per
file, and spread over the cluster by file; each holds one sampling strategy's experiments.
"""

from __future__ import annotations

import time
import uuid
import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

MEASURES = ("accuracy", "precision", "recall", "f1")
SCORE_KEYS = ("sampling", "feature_set", "model")
SCORE_COLUMNS = (*SCORE_KEYS, *MEASURES, "seconds", "best_params")
SCORE_SCHEMA = (
    "sampling string, feature_set string, model string, accuracy double, precision double, "
    "recall double, f1 double, seconds double, best_params map<string,string>"
)
# Layout of one stored JSON document; "time" is the stored name of the elapsed seconds.
DOCUMENT_TYPE = (
    "map<string,map<string,struct<accuracy:double,precision:double,recall:double,f1:double,"
    "best_params:map<string,string>,time:double>>>"
)


def empty_scores(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCORE_SCHEMA)


def _path_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def _parsed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame | None:
    """Rows (file, document), the document null where the file is broken; None without files."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if _path_missing(error):
            return None
        raise
    document = F.from_json("value", DOCUMENT_TYPE, {"mode": "PERMISSIVE"})
    return files.select(F.input_file_name().alias("file"), document.alias("document"))


def broken_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Rows (file): the score documents that cannot be read."""
    found = _parsed(spark, path)
    if found is None:
        return spark.createDataFrame([], "file string")
    return found.filter(F.col("document").isNull()).select("file")


def read_scores(
    spark: SparkSession,
    path: str | Sequence[str],
    sampling: str | None = None,
    sampling_pattern: str = r"([^/_]+)\.json$",
    mode: str = "warn",
) -> DataFrame:
    """Tidy rows of score documents; an absent path gives no rows.

    A broken document must not pass for an empty store. ``mode`` says what happens: ``warn`` names the
    files and reads the others, ``raise`` stops, ``drop`` reads the others without a word.
    :func:`broken_documents` lists them as a table.

    The sampling name is ``sampling`` or what ``sampling_pattern`` finds in the file name.
    Parameter values keep their JSON text, so numbers and lists both fit.
    """
    if mode not in ("warn", "raise", "drop"):
        raise ValueError(f"unknown mode: {mode}")
    files = _parsed(spark, path)
    if files is None:
        return empty_scores(spark)
    if mode != "drop":
        bad = [r["file"] for r in broken_documents(spark, path).limit(20).collect()]  # names for a message
        if bad and mode == "raise":
            raise ValueError(f"broken score documents: {', '.join(bad)}")
        if bad:
            warnings.warn(f"broken score documents: {', '.join(bad)}", stacklevel=2)
    name = (
        F.lit(sampling)
        if sampling is not None
        else F.regexp_extract("file", sampling_pattern, 1)
    )
    documents = files.select(name.alias("sampling"), "document")
    models = documents.select("sampling", F.explode("document").alias("feature_set", "models"))
    rows = models.select("sampling", "feature_set", F.explode("models").alias("model", "score"))
    return rows.select(
        *SCORE_KEYS,
        *[F.col(f"score.{m}").alias(m) for m in MEASURES],
        F.col("score.time").alias("seconds"),
        F.col("score.best_params").alias("best_params"),
    )


def write_scores_json(scores: DataFrame, path: str) -> str:
    """Write one nested JSON document per sampling, with all of its feature sets, in folders by sampling.

    A document's size is bounded by the number of experiments, not by the data. Read it back with a
    pattern on ``sampling=``.
    """
    entry = F.struct(
        F.col("model").alias("key"),
        F.struct(*MEASURES, "best_params", F.col("seconds").alias("time")).alias("value"),
    )
    per_set = scores.groupBy("sampling", "feature_set").agg(
        F.map_from_entries(F.collect_list(entry)).alias("models")
    )
    whole = F.map_from_entries(F.collect_list(F.struct("feature_set", "models")))
    documents = per_set.groupBy("sampling").agg(F.to_json(whole).alias("value"))
    documents.write.partitionBy("sampling").text(path)
    return path


MANIFEST = "batch string, at long"


def committed(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Rows of all committed batches below ``path`` with ``batch`` and ``at``, None without any.

    A batch is a folder of rows. It counts only when its manifest, a file of its own written afterwards, is there, so rows of
    a writer that broke off are never read, whatever they hold. One name per append is collected.
    """
    try:
        found = spark.read.schema(MANIFEST).parquet(f"{path}/manifests/*").collect()
    except AnalysisException as error:
        if _path_missing(error):
            return None
        raise
    if not found:
        return None
    folders = [f"{path}/rows/{name}" for name in sorted({r["batch"] for r in found})]
    return spark.read.schema(f"{schema}, {MANIFEST}").parquet(*folders)


def commit(rows: DataFrame, path: str) -> None:
    """Write rows as one batch. It becomes visible as a whole with its manifest; writers need no lock."""
    spark = rows.sparkSession
    batch, at = uuid.uuid4().hex, time.time_ns()
    rows.withColumns({"batch": F.lit(batch), "at": F.lit(at)}).write.parquet(f"{path}/rows/{batch}")
    spark.createDataFrame([(batch, at)], MANIFEST).coalesce(1).write.parquet(f"{path}/manifests/{batch}")


def read_score_table(spark: SparkSession, path: str) -> DataFrame:
    """The score table, or an empty one where nothing has been stored yet.

    Each experiment is there once: where several writers stored it, the earliest batch counts, then
    the first by name. So all readers see the same rows, in whatever order the writers came.
    """
    rows = committed(spark, path, SCORE_SCHEMA)
    if rows is None:
        return empty_scores(spark)
    rest = [c for c in SCORE_COLUMNS if c not in SCORE_KEYS]
    first = rows.groupBy(*SCORE_KEYS).agg(F.min_by(F.struct(*rest), F.struct("at", "batch")).alias("first"))
    return first.select(*SCORE_KEYS, *[F.col("first")[c].alias(c) for c in rest])


def append_scores(scores: DataFrame, path: str) -> DataFrame:
    """Add the experiments that are not stored yet, as one batch, and give back the whole table.

    The first result of an experiment wins: stored keys are left out by an anti join, and a
    key that the new rows repeat keeps the row that is smallest by its measures. A writer that stores the
    same experiment at the same time does no harm: see :func:`read_score_table`.
    """
    spark = scores.sparkSession
    stored = read_score_table(spark, path).select(*SCORE_KEYS)
    order = Window.partitionBy(*SCORE_KEYS).orderBy(*MEASURES, "seconds")
    fresh = (
        scores.select(*SCORE_COLUMNS)
        .join(stored, list(SCORE_KEYS), "left_anti")
        .withColumn("__turn", F.row_number().over(order))
        .filter("__turn = 1")
        .drop("__turn")
    )
    commit(fresh, path)
    return read_score_table(spark, path)


TRIAL_SCHEMA = (
    "sampling string, feature_set string, model string, plan string, turn int, point int, share double, average double"
)
TRIAL_KEYS = (*SCORE_KEYS, "plan", "turn", "point")


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Rounds of searches that are stored beside the scores, each point of a round once."""
    rows = committed(spark, f"{path}/trials", TRIAL_SCHEMA)
    if rows is None:
        return spark.createDataFrame([], TRIAL_SCHEMA)
    first = rows.groupBy(*TRIAL_KEYS).agg(F.min_by(F.struct("share", "average"), F.struct("at", "batch")).alias("first"))
    return first.select(*TRIAL_KEYS, "first.share", "first.average")


def append_trials(trials: DataFrame, path: str) -> None:
    commit(trials.select(*TRIAL_KEYS, "share", "average").coalesce(1), f"{path}/trials")
