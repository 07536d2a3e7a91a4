"""Tables of experiment scores: running what is missing, comparing, picking the best."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from rowsmith.operators.align import pending
from rowsmith.sources.score_store import MEASURES, SCORE_KEYS, append_scores, read_score_table


def run_pending(
    plan: DataFrame,
    path: str,
    run: Callable[[str, str, str], DataFrame],
    per_append: int = 16,
    hold_seconds: float = 30.0,
    side_by_side: int = 1,
    longest: Sequence[str] = (),
) -> DataFrame:
    """Run every planned experiment that the table at ``path`` lacks, so an interrupted series goes on
    where it stopped.

    ``run`` gets (sampling, feature set, model) and returns one score row. Up to ``per_append`` results that
    came within ``hold_seconds`` are stored by one append; when an experiment fails, those before it are stored first.
    Up to ``side_by_side`` experiments run at the same time. They start in the order of their sampling and feature set, the models
    named in ``longest`` before the others; the next sampling and feature set does not wait for the last model of the one before.
    The plan is a list of experiments, each of which is a series of Spark jobs; only its names reach the driver.
    """
    spark = plan.sparkSession
    todo = pending(plan, read_score_table(spark, path), SCORE_KEYS).orderBy(*SCORE_KEYS).collect()
    place = {model: i for i, model in enumerate(longest)}
    todo.sort(key=lambda item: (item[SCORE_KEYS[0]], item[SCORE_KEYS[1]], place.get(item[SCORE_KEYS[2]], len(place))))
    held: list[DataFrame] = []
    since = time.monotonic()

    def flush() -> None:
        if held:
            append_scores(reduce(DataFrame.unionByName, held), path)
            held.clear()

    try:
        with ThreadPool(side_by_side) as pool:
            start = inheritable_thread_target(spark)(lambda item: run(*[item[k] for k in SCORE_KEYS]))
            for done in pool.imap_unordered(start, todo) if side_by_side > 1 else map(start, todo):
                held.append(done)
                if len(held) >= per_append or time.monotonic() - since >= hold_seconds:
                    flush()
                    since = time.monotonic()
    finally:
        flush()
    return read_score_table(spark, path)


def _side_by_side(
    scores: DataFrame, rows: Sequence[str], pivot: str, names: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    long = scores.select(*SCORE_KEYS, *metrics).unpivot(
        list(SCORE_KEYS), list(metrics), "metric", "value"
    )
    # Names are given, so the pivot is one aggregate without a job to find them.
    return long.groupBy(*rows).pivot(pivot, list(names)).agg(F.max("value"))


def compare_models(
    scores: DataFrame, models: Sequence[str], metrics: Sequence[str] = MEASURES
) -> DataFrame:
    """Rows (sampling, feature_set, metric) with one column per model."""
    return _side_by_side(scores, ["sampling", "feature_set", "metric"], "model", models, metrics)


def compare_samplings(
    scores: DataFrame, samplings: Sequence[str], metrics: Sequence[str] = MEASURES
) -> DataFrame:
    """Rows (metric, feature_set, model) with one column per sampling strategy."""
    return _side_by_side(scores, ["metric", "feature_set", "model"], "sampling", samplings, metrics)


def best_model(
    scores: DataFrame, metric: str = "f1", by: Sequence[str] = ("sampling", "feature_set")
) -> DataFrame:
    """The best model per group; on a tie the first by name."""
    return (
        scores.filter(F.col(metric).isNotNull())
        .groupBy(*by)
        .agg(F.min(F.struct((-F.col(metric)).alias("minus"), F.col("model"))).alias("__best"))
        .select(
            *by,
            F.col("__best.model").alias("model"),
            (-F.col("__best.minus")).alias(metric),
        )
    )
