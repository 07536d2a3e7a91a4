"""Correlations and the choices made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.functions.expressions import tidy
from rowsmith.operators.correlate import (
    correlation_long,
    label_correlation,
    pair_counts,
    pearson_matrix,
    rank_table,
    spearman_matrix,
    top_correlated,
)
from rowsmith.operators.quality import clean
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

_LINE_ALL = [*LINE_FEATURES, "label"]
_PREP_ALL = [*PREP_FEATURES, "label"]


def _ranks_sql(table: str, cols: list[str], name: str) -> str:
    parts = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in cols
    )
    return f"{name} AS (SELECT {parts} FROM {table})"


def _matrix_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature, "
        + ", ".join(f"round(corr({a}, {b}), 6) + 0.0 AS {b}" for b in cols)
        + f" FROM {table}"
        for a in cols
    )


def _long_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM {table}"
        for a in cols
        for b in cols
    )


def _label_sql(table: str, cols: list[str], label: str = "label") -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS feature, corr({c}, {label}) AS corr FROM {table}"
        for i, c in enumerate(cols)
    )


def _rounded(matrix: DataFrame) -> DataFrame:
    return matrix.select("feature", *[tidy(c).alias(c) for c in matrix.columns if c != "feature"])


@query(
    "a8_spearman_vectors",
    f"""WITH {EMB_LONG_SQL}, ranks AS (
          SELECT vec_id, i, rank() OVER (PARTITION BY i ORDER BY v)
                 + (count(*) OVER (PARTITION BY i, v) - 1) / 2 AS r FROM emb_long)
        SELECT 'e' || a.i AS feature_a, 'e' || b.i AS feature_b, round(corr(a.r, b.r), 6) + 0.0 AS corr
        FROM ranks AS a JOIN ranks AS b USING (vec_id) GROUP BY a.i, b.i""",
)
def a8_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Sixty-four continuous columns: ranks go through one long table."""
    return correlation_long(emb(spark, folder), EMB_DIMS).withColumn("corr", tidy("corr"))


@query("a6_pearson_matrix", f"WITH {LINE_SQL} {_matrix_sql('line', _LINE_ALL)}")
def a6(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(pearson_matrix(line(spark, folder), _LINE_ALL))


# Features with gaps in different rows, as answers that were not given.
_GAPS = {"l_quantity": "l_linenumber % 5 = 0", "l_discount": "l_partkey % 7 = 3", "l_tax": "l_suppkey % 3 = 1 AND l_tax > 0.05"}
_GAP_ALL = [*_GAPS, "l_extendedprice"]
_GAP_SQL = (
    "gaps AS (SELECT "
    + ", ".join(f"CASE WHEN {gap} THEN NULL ELSE {c} END AS {c}" for c, gap in _GAPS.items())
    + ", l_extendedprice FROM lineitem)"
)


def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_table(spark, folder, "lineitem")
    parts = [F.when(F.expr(gap), None).otherwise(F.col(c)).alias(c) for c, gap in _GAPS.items()]
    return rows.select(*parts, "l_extendedprice")


@query("a6_pearson_pairwise", f"WITH {_GAP_SQL} {_matrix_sql('gaps', _GAP_ALL)}")
def a6_pairwise(spark: SparkSession, folder: str) -> DataFrame:
    """Each pair over the rows in which both have a value."""
    return _rounded(pearson_matrix(_gaps(spark, folder), _GAP_ALL, nulls="pairwise"))


_NO_GAP_SQL = f"whole AS (SELECT * FROM gaps WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _GAPS)})"


@query("a6_pearson_listwise", f"WITH {_GAP_SQL}, {_NO_GAP_SQL} {_matrix_sql('whole', _GAP_ALL)}")
def a6_listwise(spark: SparkSession, folder: str) -> DataFrame:
    """Only rows without a gap."""
    return _rounded(pearson_matrix(_gaps(spark, folder), _GAP_ALL))


@query(
    "a6_pair_counts",
    f"WITH {_GAP_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, CAST(regr_count({b}, {a}) AS BIGINT) AS n,
            round(regr_avgx({b}, {a}), 4) + 0.0 AS mean_a, round(covar_samp({a}, {b}), 4) + 0.0 AS covariance FROM gaps"""
        for a in _GAP_ALL
        for b in _GAP_ALL
    ),
)
def a6_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = pair_counts(_gaps(spark, folder), _GAP_ALL)
    return found.withColumns({"mean_a": tidy("mean_a", 4), "covariance": tidy("covariance", 4)})


@query(
    "a7_spearman_matrix",
    f"WITH {PREP_SQL}, {_ranks_sql('prep', _PREP_ALL, 'ranks')} {_matrix_sql('ranks', _PREP_ALL)}",
)
def a7(spark: SparkSession, folder: str) -> DataFrame:
    """Continuous columns and codes together."""
    return _rounded(spearman_matrix(prep(spark, folder), _PREP_ALL))


@query(
    "a8_correlation_long",
    f"WITH {LINE_SQL}, {_ranks_sql('line', _LINE_ALL, 'ranks')} {_long_sql('ranks', _LINE_ALL)}",
)
def a8(spark: SparkSession, folder: str) -> DataFrame:
    found = correlation_long(line(spark, folder), _LINE_ALL, "spearman")
    return found.withColumn("corr", tidy("corr"))


_SHOW_LABEL = "SELECT position, feature, round(corr, 6) + 0.0 AS corr FROM found"


@query(
    "a9_label_correlation",
    f"WITH {LINE_SQL}, found AS ({_label_sql('line', LINE_FEATURES)}) {_SHOW_LABEL}",
)
def a9(spark: SparkSession, folder: str) -> DataFrame:
    found = label_correlation(line(spark, folder), LINE_FEATURES, "label", "pearson")
    return found.withColumn("corr", tidy("corr"))


@query(
    "a9_label_correlation_spearman",
    f"""WITH {PREP_SQL}, {_ranks_sql('prep', _PREP_ALL, 'ranks')},
        found AS ({_label_sql('ranks', PREP_FEATURES)}) {_SHOW_LABEL}""",
)
def a9_spearman(spark: SparkSession, folder: str) -> DataFrame:
    found = label_correlation(prep(spark, folder), PREP_FEATURES, "label", "spearman")
    return found.withColumn("corr", tidy("corr"))


_CLEAN_PREP = f"""
clean AS (
  SELECT {', '.join(PREP_FEATURES)}, min(label) AS label FROM prep
  GROUP BY {', '.join(PREP_FEATURES)} HAVING count(DISTINCT label) = 1)
"""


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Clean the order facts, correlate each feature with the label, keep the top four."""
    rows = clean(prep(spark, folder).drop("o_orderkey"), PREP_FEATURES, "label")
    found = top_correlated(rows, PREP_FEATURES, "label", 4, "pearson")
    return found.withColumn("corr", tidy("corr"))


query(
    "o1_top_correlated",
    f"""WITH {PREP_SQL}, {_CLEAN_PREP}, found AS ({_label_sql('clean', PREP_FEATURES)})
        {_SHOW_LABEL} ORDER BY abs(corr) DESC, position LIMIT 4""",
)(flagship)


@query(
    "o1_top_correlated_spearman",
    f"""WITH {LINE_SQL}, {_ranks_sql('line', _LINE_ALL, 'ranks')},
        found AS ({_label_sql('ranks', LINE_FEATURES)})
        {_SHOW_LABEL} ORDER BY abs(corr) DESC, position LIMIT 3""",
)
def o1_spearman(spark: SparkSession, folder: str) -> DataFrame:
    found = top_correlated(line(spark, folder), LINE_FEATURES, "label", 3, "spearman")
    return found.withColumn("corr", tidy("corr"))


def _rank_rows_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS value, count(*) AS n,
            CAST(sum(count(*)) OVER (ORDER BY {c}) AS DOUBLE) - count(*) + (count(*) + 1) / 2 AS rank
            FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in cols
    )


@query("w2_average_rank", _rank_rows_sql("lineitem", ["l_extendedprice", "l_quantity", "l_tax"]))
def w2(spark: SparkSession, folder: str) -> DataFrame:
    return rank_table(load_table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity", "l_tax"])


@query(
    "w2_average_rank_bucketed",
    _rank_rows_sql("lineitem", ["l_extendedprice", "l_quantity"]),
)
def w2_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same through many small value buckets, as on data too large for one."""
    rows = load_table(spark, folder, "lineitem")
    return rank_table(rows, ["l_extendedprice", "l_quantity"], rows_per_bucket=2000)
