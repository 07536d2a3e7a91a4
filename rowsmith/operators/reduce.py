"""Fewer features: principal components, eigenvalues, clusters.

Spark computes the covariance or correlation matrix; only that d x d matrix, whose size does
not depend on the rows, is decomposed on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, PCAModel, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.storagelevel import StorageLevel

from rowsmith.operators.columns import HEALTH_COMPOSITES, assemble
from rowsmith.operators.correlate import correlation_array


@dataclass(frozen=True)
class FittedComponents:
    """A fitted projection: ``loadings`` is features x components, ``ratios`` the share of
    the variance per component."""

    cols: tuple[str, ...]
    loadings: np.ndarray
    ratios: np.ndarray
    prepare: object
    model: PCAModel


def fit_components(
    df: DataFrame, cols: Sequence[str], k: int | None = None, standardize: bool = False
) -> FittedComponents:
    """Principal components of the covariance, or of the correlation if standardised."""
    cols = tuple(cols)

    def vectors(frame: DataFrame) -> DataFrame:
        return assemble(frame, cols, "__raw")

    source, column = vectors(df), "__raw"
    if standardize:
        scaler = StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=False, withStd=True)
        scale = scaler.fit(source)
        source, column = scale.transform(source), "__scaled"

        def prepare(frame: DataFrame) -> DataFrame:
            return scale.transform(vectors(frame)).drop("__raw")
    else:
        prepare = vectors
    model = PCA(k=k or len(cols), inputCol=column, outputCol="__scores").fit(source.select(column))
    return FittedComponents(
        cols, model.pc.toArray(), np.asarray(model.explainedVariance.toArray()), prepare, model
    )


def pca_fit(df: DataFrame, cols: Sequence[str], k: int | None = None, standardize: bool = False) -> DataFrame:
    """Rows (feature, component, loading, ratio); components count from 1."""
    fit = fit_components(df, cols, k, standardize)
    rows = [
        (feature, j + 1, float(fit.loadings[i, j]), float(fit.ratios[j]))
        for i, feature in enumerate(fit.cols)
        for j in range(fit.loadings.shape[1])
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, component int, loading double, ratio double"
    )


def pca_project(
    df: DataFrame, cols: Sequence[str], k: int, standardize: bool = False, prefix: str = "pc"
) -> DataFrame:
    """Add pc1..pck, the projection of each row as it is (not centred)."""
    fit = fit_components(df, cols, k, standardize)
    scored = fit.model.transform(fit.prepare(df))
    return scored.withColumn("__parts", vector_to_array("__scores")).select(
        *df.columns, *[F.element_at("__parts", j).alias(f"{prefix}{j}") for j in range(1, k + 1)]
    )


def absolute_contributions(df: DataFrame, cols: Sequence[str], n: int, standardize: bool = False) -> DataFrame:
    """Rows (position, feature, contribution): absolute loadings summed over n components."""
    fit = fit_components(df, cols, n, standardize)
    sums = np.abs(fit.loadings).sum(axis=1)
    rows = [(i, c, float(sums[i])) for i, c in enumerate(fit.cols)]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, contribution double")


def top_contributors(df: DataFrame, cols: Sequence[str], k: int, standardize: bool = False) -> DataFrame:
    """The k features that load most on the first k components; every feature competes."""
    ranked = absolute_contributions(df, cols, k, standardize)
    return ranked.orderBy(F.col("contribution").desc(), "position").limit(k)


def explained_variance_table(
    df: DataFrame, cols: Sequence[str], k: int | None = None, standardize: bool = False
) -> DataFrame:
    """Rows (component, ratio, cumulative)."""
    fit = fit_components(df, cols, k, standardize)
    rows = [(j + 1, float(r)) for j, r in enumerate(fit.ratios)]
    # One row per component, so a single window partition is bounded by the feature count.
    so_far = Window.partitionBy(F.lit(1)).orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    table = df.sparkSession.createDataFrame(rows, "component int, ratio double")
    return table.withColumn("cumulative", F.sum("ratio").over(so_far))


def choose_components(
    df: DataFrame, cols: Sequence[str], threshold: float = 0.75, standardize: bool = False
) -> DataFrame:
    """One row: the fewest components that explain at least ``threshold``."""
    table = explained_variance_table(df, cols, None, standardize)
    enough = table.filter(F.col("cumulative") >= threshold)
    return enough.agg(F.min("component").alias("components"), F.min("cumulative").alias("cumulative"))


def choose_by_elbow(df: DataFrame, cols: Sequence[str], standardize: bool = False) -> DataFrame:
    """One row: the component farthest from the line between the first and last ratio."""
    table = explained_variance_table(df, cols, None, standardize)
    ends = table.agg(
        F.struct(
            F.min("component").alias("x0"),
            F.max("component").alias("x1"),
            F.min_by("ratio", "component").alias("y0"),
            F.max_by("ratio", "component").alias("y1"),
        )
    ).scalar()
    rise = ends["y1"] - ends["y0"]
    run = (ends["x1"] - ends["x0"]).cast("double")
    gap = F.abs(rise * (F.col("component") - ends["x0"]) - run * (F.col("ratio") - ends["y0"]))
    distance = F.when(run > 0, gap / F.sqrt(rise * rise + run * run)).otherwise(F.lit(0.0))
    return (
        table.withColumn("distance", distance)
        .orderBy(F.col("distance").desc(), "component")
        .limit(1)
        .select(F.col("component").alias("components"), "distance")
    )


def factor_eigenvalues(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """Rows (factor, eigenvalue, keep) of the correlation matrix; factors from 1 up are kept."""
    values = np.linalg.eigvalsh(correlation_array(df, cols, method))[::-1]
    rows = [(i + 1, float(v), bool(v >= 1)) for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, "factor int, eigenvalue double, keep boolean")


def varimax(loadings: np.ndarray, tolerance: float = 1e-10, rounds: int = 200) -> np.ndarray:
    """Turn factors so that each feature loads on few of them; communalities and reproduced correlations stay.

    Two factors at a time are turned by the angle at which the variance of their squared loadings is largest, which has
    a closed form, so a pair is not left where that variance is smallest. Rounds go on until no pair turns any more.
    """
    out = loadings.copy()
    for _ in range(rounds):
        most = 0.0
        for p in range(out.shape[1]):
            for q in range(p + 1, out.shape[1]):
                x, y = out[:, p], out[:, q]
                u, v = x * x - y * y, 2 * x * y
                top = 2 * ((u * v).mean() - u.mean() * v.mean())
                bottom = (u * u - v * v).mean() - u.mean() ** 2 + v.mean() ** 2
                angle = np.arctan2(top, bottom) / 4 if max(abs(top), abs(bottom)) > 1e-15 else 0.0
                most = max(most, abs(angle))
                c, s = np.cos(angle), np.sin(angle)
                out[:, p], out[:, q] = c * x + s * y, c * y - s * x
        if most < tolerance:
            break
    return out


def _signed(loadings: np.ndarray) -> np.ndarray:
    """Strongest factor first, each with its largest loading positive."""
    order = np.argsort(-(loadings**2).sum(axis=0), kind="stable")
    ordered = loadings[:, order]
    largest = ordered[np.abs(ordered).argmax(axis=0), np.arange(ordered.shape[1])]
    return ordered * np.where(largest < 0, -1.0, 1.0)


def factor_loadings(
    df: DataFrame, cols: Sequence[str], factors: int | None = None, method: str = "pearson"
) -> DataFrame:
    """Rows (feature, factor, loading, rotated, communality) of the factors behind a correlation matrix.

    Factors are its principal ones, each scaled by the root of its eigenvalue: ``factors`` of them, or those with an
    eigenvalue of at least 1. ``rotated`` is the loading after varimax. Only the d x d matrix is on the driver.
    """
    values, vectors = np.linalg.eigh(correlation_array(df, cols, method))
    values, vectors = values[::-1], vectors[:, ::-1]
    count = max(1, int((values >= 1).sum())) if factors is None else factors
    plain = _signed(vectors[:, :count] * np.sqrt(np.maximum(values[:count], 0.0)))
    rotated = _signed(varimax(plain))
    shared = (plain**2).sum(axis=1)
    rows = [
        (feature, f + 1, float(plain[i, f]), float(rotated[i, f]), float(shared[i]))
        for i, feature in enumerate(cols)
        for f in range(count)
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, factor int, loading double, rotated double, communality double"
    )


def silhouettes(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Rows (*cluster*, n, silhouette): the mean simplified silhouette of each cluster's rows.

    A row's silhouette is (b - a) / max(a, b), a its distance to its own cluster's mean and b that to the nearest
    other mean; 0 if both are 0. So a row meets the k means and never another row: one pass for the means, one for
    the silhouettes, both combined in the tasks. Null with a single cluster. Rows with a null are left out.
    """
    rows = df.select(F.col(cluster).alias("__own"), *[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    means = rows.groupBy("__own").agg(F.array(*[F.avg(c) for c in cols]).alias("at"))
    # One row per cluster, gathered into one array that each row is compared with.
    every = means.agg(F.collect_list(F.struct(F.col("__own").alias("cluster"), "at")).alias("all")).scalar()
    here = F.array(*cols)

    def distance(centre: Column) -> Column:
        gaps = F.zip_with(here, centre["at"], lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap))

    measured = rows.withColumn("__all", every).select(
        "__own", F.transform("__all", lambda c: F.struct((c["cluster"] != F.col("__own")).alias("other"), distance(c).alias("far"))).alias("to")
    )
    own = F.get(F.filter("to", lambda x: ~x["other"]), F.lit(0))["far"]
    other = F.array_min(F.transform(F.filter("to", lambda x: x["other"]), lambda x: x["far"]))
    measured = measured.select("__own", own.alias("a"), other.alias("b"))
    larger = F.greatest("a", "b")
    one = F.when(F.col("b").isNotNull(), F.when(larger > 0, (F.col("b") - F.col("a")) / larger).otherwise(F.lit(0.0)))
    return measured.groupBy(F.col("__own").alias(cluster)).agg(F.count(F.lit(1)).alias("n"), F.avg(one).alias("silhouette"))


def mean_silhouette(by_cluster: DataFrame) -> DataFrame:
    """One row (clusters, n, silhouette) from the rows of :func:`silhouettes`."""
    return by_cluster.agg(
        F.count(F.lit(1)).alias("clusters"),
        F.sum("n").alias("n"),
        (F.sum(F.col("silhouette") * F.col("n")) / F.sum("n")).alias("silhouette"),
    )


def choose_clusters(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 42, components: int | None = None
) -> DataFrame:
    """Rows (k, cost, silhouette, chosen): k-means for each k, and the k with the largest mean simplified silhouette.

    On a tie the smaller k. With ``components`` the rows are clustered, and measured, in that projection.
    """
    if components is not None:
        names = [f"__pc{j}" for j in range(1, components + 1)]
        df, cols = pca_project(df, cols, components, prefix="__pc"), names
    source = assemble(df, cols).select(*cols, "features").persist(StorageLevel.MEMORY_AND_DISK)
    found = []
    try:
        for k in ks:
            model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="__cluster").fit(source)
            score = mean_silhouette(silhouettes(model.transform(source), cols, "__cluster")).head()["silhouette"]
            found.append((k, float(model.summary.trainingCost), score))
    finally:
        source.unpersist()
    best = max((x for x in found if x[2] is not None), key=lambda x: (x[2], -x[0]), default=(None,))[0]
    return df.sparkSession.createDataFrame(
        [(*x, x[0] == best) for x in found], "k int, cost double, silhouette double, chosen boolean"
    )


def _cluster_input(df: DataFrame, cols: Sequence[str], components: int | None) -> DataFrame:
    if components is None:
        return assemble(df, cols)
    names = [f"__pc{j}" for j in range(1, components + 1)]
    return assemble(pca_project(df, cols, components, prefix="__pc"), names)


def kmeans_clusters(
    df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, components: int | None = None
) -> DataFrame:
    """Add ``cluster``; with ``components`` the rows are clustered in that projection."""
    source = _cluster_input(df, cols, components)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(source)
    return model.transform(source).select(*df.columns, "cluster")


def kmeans_cost_curve(
    df: DataFrame,
    cols: Sequence[str],
    ks: Sequence[int],
    seed: int = 42,
    components: int | None = None,
) -> DataFrame:
    """Rows (k, cost): the summed squared distance to the nearest centre for each k."""
    source = _cluster_input(df, cols, components).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = [(k, float(KMeans(k=k, seed=seed).fit(source).summary.trainingCost)) for k in ks]
    finally:
        source.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double")


def pca_filter(
    df: DataFrame,
    cols: Sequence[str],
    k: int,
    composites: Mapping[str, str] | None = HEALTH_COMPOSITES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Reduce to the k strongest contributors plus the composite features.

    Composites that the frame already has are taken as they are, the others are computed.
    ``keep`` names columns, such as key and label, that stay in front.
    """
    chosen = [row["feature"] for row in top_contributors(df, cols, k).collect()]
    spec = composites or {}
    missing = {name: text for name, text in spec.items() if name not in df.columns}
    wide = df.withColumns({n: F.expr(t) for n, t in missing.items()}) if missing else df
    return wide.select(*keep, *chosen, *spec)
