"""Components, eigenvalues and clusters.

A decomposition is checked by what it must give back: loadings and ratios rebuild the
covariance shares, eigenvalues the sums over the correlation matrix. Two columns have closed
forms. Signs of components are arbitrary, so single loadings are compared without sign.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowsmith.functions.expressions import tidy
from rowsmith.operators.correlate import correlation_array
from rowsmith.operators.reduce import (
    absolute_contributions,
    choose_by_elbow,
    choose_clusters,
    choose_components,
    explained_variance_table,
    factor_eigenvalues,
    factor_loadings,
    kmeans_clusters,
    kmeans_cost_curve,
    pca_filter,
    pca_fit,
    pca_project,
    silhouettes,
    top_contributors,
)
from rowsmith.operators.wide import fit_wide, wide_components, wide_scores
from rowsmith.plans.inputs import (
    EMB_DIMS,
    EMB_LONG_SQL,
    LINE_FEATURES,
    LINE_SQL,
    PREP_FEATURES,
    PREP_SQL,
    emb,
    line,
    prep,
)
from rowsmith.plans.registry import query
from rowsmith.sources.tables import load_table

# Two columns: the angle of the first axis and both eigenvalues.
_ANGLE_SQL = f"""
WITH {PREP_SQL}, moments AS (
  SELECT var_samp(month) AS a, var_samp(priority) AS c, covar_samp(month, priority) AS b FROM prep),
axes AS (
  SELECT 0.5 * atan2(2 * b, a - c) AS angle,
         ((a + c) + sqrt((a - c) * (a - c) + 4 * b * b)) / 2 / (a + c) AS first_share
  FROM moments)
"""
_PAIR = ["month", "priority"]


@query(
    "l1_pca_fit",
    f"WITH {PREP_SQL}, whole AS (SELECT "
    + " + ".join(f"var_samp({c})" for c in PREP_FEATURES)
    + " AS total FROM prep) "
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b,
            round(covar_samp({a}, {b}) / any_value(total), 6) + 0.0 AS share FROM prep, whole"""
        for a in PREP_FEATURES
        for b in PREP_FEATURES
    ),
)
def l1(spark: SparkSession, folder: str) -> DataFrame:
    """All components of the order features; the covariance shares are rebuilt from them."""
    return _rebuilt(pca_fit(prep(spark, folder), PREP_FEATURES))


def _rebuilt(fitted: DataFrame) -> DataFrame:
    left = fitted.select(F.col("feature").alias("feature_a"), "component", F.col("loading").alias("a"), "ratio")
    right = fitted.select(F.col("feature").alias("feature_b"), "component", F.col("loading").alias("b"))
    pairs = left.join(right, "component").groupBy("feature_a", "feature_b")
    return pairs.agg(tidy(F.sum(F.col("a") * F.col("b") * F.col("ratio"))).alias("share"))


@query(
    "l1_pca_fit_vectors",
    f"""WITH {EMB_LONG_SQL},
         total AS (SELECT sum(var) AS total FROM (SELECT var_samp(v) AS var FROM emb_long GROUP BY i))
       SELECT 'e' || a.i AS feature_a, 'e' || b.i AS feature_b,
              round(covar_samp(a.v, b.v) / any_value(total), 6) + 0.0 AS share
       FROM emb_long AS a JOIN emb_long AS b USING (vec_id), total GROUP BY a.i, b.i""",
)
def l1_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The same over the whole vectors, with all sixty-four components."""
    return _rebuilt(pca_fit(emb(spark, folder), EMB_DIMS))


@query(
    "l1_wide_components",
    f"""WITH {EMB_LONG_SQL}
       SELECT a.i AS a, b.i AS b, round(covar_samp(a.v, b.v), 6) + 0.0 AS covariance
       FROM emb_long AS a JOIN emb_long AS b USING (vec_id) GROUP BY a.i, b.i""",
)
def l1_wide(spark: SparkSession, folder: str) -> DataFrame:
    """All components, found 16 directions at a time; the covariances are rebuilt from them."""
    found = wide_components(load_table(spark, folder, "embeddings"), "embedding", 64, width=16)
    long = found.select("component", "eigenvalue", F.posexplode("loadings").alias("place", "loading"))
    left = long.select((F.col("place") + 1).cast("long").alias("a"), "component", "eigenvalue", F.col("loading").alias("x"))
    right = long.select((F.col("place") + 1).cast("long").alias("b"), "component", F.col("loading").alias("y"))
    pairs = left.join(right, "component").groupBy("a", "b")
    return pairs.agg(tidy(F.sum(F.col("x") * F.col("y") * F.col("eigenvalue"))).alias("covariance"))


@query(
    "l2_wide_project",
    f"WITH {EMB_LONG_SQL} SELECT vec_id, round(sum(v * v), 6) + 0.0 AS length2 FROM emb_long GROUP BY vec_id",
)
def l2_wide(spark: SparkSession, folder: str) -> DataFrame:
    """A turn into all components keeps the length of every vector."""
    rows = load_table(spark, folder, "embeddings")
    fit = fit_wide(rows, "embedding", 64, width=16)
    turned = rows.select("vec_id", wide_scores(F.col("embedding"), fit).alias("scores"))
    length = F.aggregate("scores", F.lit(0.0), lambda total, x: total + x * x)
    return turned.select("vec_id", tidy(length).alias("length2"))


@query(
    "l4_wide_eigenvalues",
    "SELECT unnest(range(1, 6)) AS factor, true AS same_value, true AS same_direction",
)
def l4_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The five strongest factors of the correlation matrix, beside those of the whole matrix."""
    fit = fit_wide(load_table(spark, folder, "embeddings"), "embedding", 5, standardize=True, tolerance=1e-9)
    values, vectors = np.linalg.eigh(correlation_array(emb(spark, folder), EMB_DIMS, "pearson"))
    overlap = np.abs((vectors[:, ::-1][:, :5] * fit.loadings).sum(axis=0))
    same = [
        (j + 1, bool(abs(values[-1 - j] - fit.values[j]) < 1e-6), bool(overlap[j] > 1 - 1e-6)) for j in range(5)
    ]
    return spark.createDataFrame(same, "factor long, same_value boolean, same_direction boolean")


@query(
    "l2_pca_project",
    f"""{_ANGLE_SQL} SELECT o_orderkey,
        round(abs(cos(angle) * month + sin(angle) * priority), 6) + 0.0 AS pc1,
        round(abs(cos(angle) * priority - sin(angle) * month), 6) + 0.0 AS pc2
        FROM prep, axes""",
)
def l2(spark: SparkSession, folder: str) -> DataFrame:
    found = pca_project(prep(spark, folder), _PAIR, 2)
    return found.select(
        "o_orderkey", tidy(F.abs("pc1")).alias("pc1"), tidy(F.abs("pc2")).alias("pc2")
    )


@query(
    "l3_choose_components",
    f"""{_ANGLE_SQL} SELECT CAST(CASE WHEN first_share >= 0.75 THEN 1 ELSE 2 END AS INTEGER) AS components,
        round(CASE WHEN first_share >= 0.75 THEN first_share ELSE 1 END, 6) + 0.0 AS cumulative
        FROM axes""",
)
def l3(spark: SparkSession, folder: str) -> DataFrame:
    found = choose_components(prep(spark, folder), _PAIR, 0.75)
    return found.withColumn("cumulative", tidy("cumulative"))


# Three columns: eigenvalues of a symmetric 3 x 3 matrix by the cosine form.
_TRIO = ["month", "priority", "region5"]
_TRIO_SQL = f"""
WITH {PREP_SQL}, m AS (
  SELECT var_samp(month) AS a, var_samp(priority) AS b, var_samp(region5) AS c,
         covar_samp(month, priority) AS d, covar_samp(priority, region5) AS e,
         covar_samp(month, region5) AS f FROM prep),
centred AS (SELECT *, (a + b + c) / 3 AS q FROM m),
scaled AS (
  SELECT *, sqrt((power(a - q, 2) + power(b - q, 2) + power(c - q, 2)
                  + 2 * (d * d + e * e + f * f)) / 6) AS p FROM centred),
angled AS (
  SELECT *, acos(greatest(-1, least(1, ((a - q) * ((b - q) * (c - q) - e * e)
                  - d * (d * (c - q) - e * f) + f * (d * e - (b - q) * f)) / (2 * p * p * p)))) / 3 AS phi
  FROM scaled),
ends AS (SELECT q, q + 2 * p * cos(phi) AS v1, q + 2 * p * cos(phi + 2 * pi() / 3) AS v3 FROM angled),
shares AS (
  SELECT v1 / (3 * q) AS s1, (3 * q - v1 - v3) / (3 * q) AS s2, v3 / (3 * q) AS s3 FROM ends),
variance AS (
  SELECT 1 AS component, s1 AS ratio, s1 AS cumulative FROM shares
  UNION ALL SELECT 2, s2, s1 + s2 FROM shares
  UNION ALL SELECT 3, s3, 1.0::DOUBLE FROM shares)
"""


@query(
    "l3_choose_components_three",
    f"""{_TRIO_SQL} SELECT min(component) AS components, round(min(cumulative), 6) + 0.0 AS cumulative
        FROM variance WHERE cumulative >= 0.9""",
)
def l3_three(spark: SparkSession, folder: str) -> DataFrame:
    found = choose_components(prep(spark, folder), _TRIO, 0.9)
    return found.withColumn("cumulative", tidy("cumulative"))


@query(
    "l3_choose_by_elbow",
    f"""{_TRIO_SQL}, gaps AS (
          SELECT component, abs((s3 - s1) * (component - 1) - 2 * (ratio - s1))
                            / sqrt((s3 - s1) * (s3 - s1) + 4) AS distance FROM variance, shares)
        SELECT component AS components, round(distance, 6) + 0.0 AS distance
        FROM gaps ORDER BY gaps.distance DESC, component LIMIT 1""",
)
def l3_elbow(spark: SparkSession, folder: str) -> DataFrame:
    return choose_by_elbow(prep(spark, folder), _TRIO).withColumn("distance", tidy("distance"))


@query(
    "w1_explained_variance_table",
    f"""{_TRIO_SQL} SELECT component, round(ratio, 6) + 0.0 AS ratio,
        round(cumulative, 6) + 0.0 AS cumulative FROM variance""",
)
def w1(spark: SparkSession, folder: str) -> DataFrame:
    found = explained_variance_table(prep(spark, folder), _TRIO)
    return found.select("component", tidy("ratio").alias("ratio"), tidy("cumulative").alias("cumulative"))


@query(
    "a10_absolute_contributions",
    f"""{_ANGLE_SQL} SELECT 0 AS position, 'month' AS feature,
        round(abs(cos(angle)), 6) + 0.0 AS contribution FROM axes
        UNION ALL SELECT 1, 'priority', round(abs(sin(angle)), 6) + 0.0 FROM axes""",
)
def a10(spark: SparkSession, folder: str) -> DataFrame:
    found = absolute_contributions(prep(spark, folder), _PAIR, 1)
    return found.withColumn("contribution", tidy("contribution"))


@query(
    "o2_top_contributors",
    f"""{_ANGLE_SQL} SELECT CAST(CASE WHEN abs(cos(angle)) >= abs(sin(angle)) THEN 0 ELSE 1 END AS INTEGER) AS position,
        CASE WHEN abs(cos(angle)) >= abs(sin(angle)) THEN 'month' ELSE 'priority' END AS feature,
        round(greatest(abs(cos(angle)), abs(sin(angle))), 6) + 0.0 AS contribution FROM axes""",
)
def o2(spark: SparkSession, folder: str) -> DataFrame:
    found = top_contributors(prep(spark, folder), _PAIR, 1)
    return found.withColumn("contribution", tidy("contribution"))


@query(
    "l4_factor_eigenvalues",
    f"""WITH {PREP_SQL}, r AS (SELECT abs(corr(price, acctbal)) AS r FROM prep)
        SELECT 1 AS factor, round(1 + r, 6) + 0.0 AS eigenvalue, true AS keep FROM r
        UNION ALL SELECT 2, round(1 - r, 6) + 0.0, 1 - r >= 1 FROM r""",
)
def l4(spark: SparkSession, folder: str) -> DataFrame:
    found = factor_eigenvalues(prep(spark, folder), ["price", "acctbal"])
    return found.withColumn("eigenvalue", tidy("eigenvalue"))


@query(
    "l4_factor_eigenvalues_many",
    f"""WITH {EMB_LONG_SQL}, r AS (
          SELECT corr(a.v, b.v) AS r FROM emb_long AS a JOIN emb_long AS b USING (vec_id) GROUP BY a.i, b.i)
        SELECT CAST(64 AS BIGINT) AS factors, 64.0::DOUBLE AS total, round(sum(r * r), 6) + 0.0 AS squares FROM r""",
)
def l4_many(spark: SparkSession, folder: str) -> DataFrame:
    """Eigenvalues add up to the columns, their squares to all squared correlations."""
    found = factor_eigenvalues(emb(spark, folder), EMB_DIMS)
    return found.agg(
        F.count(F.lit(1)).alias("factors"),
        tidy(F.sum("eigenvalue")).alias("total"),
        tidy(F.sum(F.col("eigenvalue") * F.col("eigenvalue"))).alias("squares"),
    )


@query(
    "l4_factor_loadings",
    f"""WITH {PREP_SQL}, r AS (SELECT abs(corr(price, acctbal)) AS r FROM prep),
        l AS (SELECT sqrt((1 + r) / 2) AS a, sqrt((1 - r) / 2) AS b FROM r)
        SELECT feature, factor, round(CASE factor WHEN 1 THEN a ELSE b END, 6) + 0.0 AS loading,
               round(CASE WHEN (feature = 'price') = (factor = 1) THEN a + b ELSE a - b END / sqrt(2), 6) + 0.0 AS rotated,
               1.0::DOUBLE AS communality
        FROM l, (VALUES ('price'), ('acctbal')) AS f(feature), (VALUES (1), (2)) AS g(factor)""",
)
def l4_loadings(spark: SparkSession, folder: str) -> DataFrame:
    """Two columns have a closed form: both load alike on each factor, and varimax turns the factors by an eighth.
    The turned factors are equally strong, so they are named by the column that loads on them."""
    found = factor_loadings(prep(spark, folder), ["price", "acctbal"], 2)
    strongest = Window.partitionBy("factor").orderBy(F.abs("rotated").desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    turned = found.withColumn("mine", F.first("feature").over(strongest)).select(
        "feature", F.when(F.col("mine") == "price", 1).otherwise(2).alias("factor"), F.abs("rotated").alias("rotated")
    )
    plain = found.select("feature", "factor", F.abs("loading").alias("loading"), "communality")
    return plain.join(turned, ["feature", "factor"]).select(
        "feature", "factor", *[tidy(c).alias(c) for c in ("loading", "rotated", "communality")]
    )


@query(
    "l4_reproduced_correlations",
    f"""WITH {EMB_LONG_SQL}, r AS (
          SELECT a.i AS i, b.i AS j, corr(a.v, b.v) AS r FROM emb_long AS a JOIN emb_long AS b USING (vec_id) GROUP BY a.i, b.i)
        SELECT CAST(count(*) AS BIGINT) AS pairs, round(sum(r), 6) + 0.0 AS total, round(sum(r * r), 6) + 0.0 AS squares FROM r""",
)
def l4_reproduced(spark: SparkSession, folder: str) -> DataFrame:
    """All rotated factors together give every correlation back: the product of two columns' loadings, summed over factors."""
    found = factor_loadings(emb(spark, folder), EMB_DIMS, len(EMB_DIMS)).select("feature", "factor", "rotated")
    other = found.select(F.col("feature").alias("with"), "factor", F.col("rotated").alias("its"))
    pairs = found.join(other, "factor").groupBy("feature", "with").agg(F.sum(F.col("rotated") * F.col("its")).alias("r"))
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"), tidy(F.sum("r")).alias("total"), tidy(F.sum(F.col("r") * F.col("r"))).alias("squares")
    )


_FIXED_KS = (2, 5)


def _silhouette_sql(k: int) -> str:
    return f"""
    SELECT CAST({k} AS INTEGER) AS k, cluster, count(*) AS n,
           round(avg(CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) + 0.0 AS silhouette
    FROM (
      SELECT vec_id, cluster, min(d) FILTER (WHERE c = cluster) AS a, min(d) FILTER (WHERE c <> cluster) AS b
      FROM (
        SELECT vec_id, r.cluster, m.cluster AS c, sqrt(sum((r.v - m.v) * (r.v - m.v))) AS d
        FROM (SELECT vec_id, i, v, CAST(label % {k} AS INTEGER) AS cluster FROM emb_long JOIN embeddings USING (vec_id)) r
        JOIN (SELECT CAST(label % {k} AS INTEGER) AS cluster, i, avg(v) AS v
              FROM emb_long JOIN embeddings USING (vec_id) GROUP BY ALL) m USING (i)
        GROUP BY ALL)
      GROUP BY ALL)
    GROUP BY cluster"""


@query("l5_silhouettes", f"WITH {EMB_LONG_SQL} {' UNION ALL '.join(map(_silhouette_sql, _FIXED_KS))}")
def l5_silhouettes(spark: SparkSession, folder: str) -> DataFrame:
    """Of clusters that are given: the rows of a label's remainder by k."""
    rows = emb(spark, folder)
    parts = []
    for k in _FIXED_KS:
        found = silhouettes(rows.withColumn("cluster", (F.col("label") % k).cast("int")), EMB_DIMS)
        parts.append(found.select(F.lit(k).alias("k"), "cluster", "n", tidy("silhouette").alias("silhouette")))
    return reduce(DataFrame.unionByName, parts)


@query("l5_choose_clusters", "SELECT unnest([2, 4, 8]) AS k, true AS in_range, true AS one_chosen WHERE (SELECT count(*) FROM embeddings) > 8")
def l5_choose(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: every k has a silhouette and exactly one k, that of the largest, is chosen."""
    found = choose_clusters(emb(spark, folder), EMB_DIMS, [2, 4, 8], components=3)
    whole = Window.partitionBy(F.lit(1))
    best = F.max("silhouette").over(whole)
    right = (F.sum(F.col("chosen").cast("int")).over(whole) == 1) & (~F.col("chosen") | (F.col("silhouette") == best))
    return found.select("k", F.col("silhouette").between(-1, 1).alias("in_range"), right.alias("one_chosen"))


@query(
    "l5_kmeans_clusters",
    "SELECT count(*) AS n, CAST(5 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced FROM embeddings",
)
def l5(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: every row has one of k clusters, and no row is far nearer to another cluster's
    mean than to its own."""
    rows = kmeans_clusters(emb(spark, folder), EMB_DIMS, 5)
    means = rows.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in EMB_DIMS])
    # Five rows, gathered into one array that each row is compared with.
    centres = means.agg(F.collect_list(F.struct("cluster", F.array(*EMB_DIMS).alias("at"))).alias("all"))
    own = F.array(*EMB_DIMS)

    def distance(centre: Column) -> Column:
        gaps = F.zip_with(own, centre["at"], lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)

    measured = rows.withColumn("centres", centres.scalar()).select(
        "cluster",
        F.array_min(F.transform("centres", distance)).alias("nearest"),
        F.element_at(
            F.transform(F.filter("centres", lambda c: c["cluster"] == F.col("cluster")), distance), 1
        ).alias("mine"),
    )
    return measured.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("cluster").alias("clusters"),
        F.count_if(F.col("mine") > F.col("nearest") * 1.1).alias("misplaced"),
    )


@query(
    "l5_kmeans_cost_curve",
    """SELECT unnest([2, 4, 8]) AS k, true AS falling
       WHERE (SELECT count(*) FROM embeddings) > 8""",
)
def l5_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: the cost falls as k doubles, in a projection onto three components."""
    curve = kmeans_cost_curve(emb(spark, folder), EMB_DIMS, [2, 4, 8], components=3)
    before = F.lag("cost").over(Window.partitionBy(F.lit(1)).orderBy("k"))
    return curve.select("k", F.coalesce(F.col("cost") <= before * 1.001, F.lit(True)).alias("falling"))


@query(
    "l6_pca_filter",
    f"WITH {LINE_SQL} SELECT l_quantity, l_linenumber, l_quantity * l_discount AS rebate FROM line",
)
def l6(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity and line number vary most by far, so they are the two that stay."""
    return pca_filter(
        line(spark, folder), LINE_FEATURES, 2, {"rebate": "l_quantity * l_discount"}
    )
