from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsmith.operators.align import align, align_by_position, align_outer, pending, with_group_facts, with_position
from rowsmith.operators.columns import (
    HEALTH_COMPOSITES,
    assemble,
    composite_features,
    filter_not,
    rename_all,
    split_xy,
    union_classes,
    with_row_id,
)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_position_alignment_across_partitionings(spark):
    x = spark.createDataFrame([(i * 10,) for i in range(10)], "x int")
    y = spark.createDataFrame([(i,) for i in range(10)], "y int")
    x4 = spark.createDataFrame(x.rdd.coalesce(4), x.schema)
    y2 = spark.createDataFrame(y.rdd.coalesce(2), y.schema)
    assert x4.rdd.getNumPartitions() != y2.rdd.getNumPartitions()
    found = align_by_position(x4, y2)
    assert rows_of(found) == Counter((i * 10, i) for i in range(10))


def test_positions_have_no_gaps(spark):
    df = spark.range(1000).repartition(9).filter("id % 3 = 0")
    places = sorted(r["position"] for r in with_position(df).collect())
    assert places == list(range(334))
    assert with_position(spark.range(0)).count() == 0


def test_row_ids_are_unique(spark):
    df = with_row_id(spark.range(100).repartition(7))
    assert df.select("row_id").distinct().count() == 100


def test_align_inner_and_outer(spark):
    x = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    y = spark.createDataFrame([(2, 0), (3, 1)], "k int, label int")
    assert rows_of(align(x, y, "k")) == Counter([(2, "b", 0)])
    assert rows_of(align_outer(x, y, "k")) == Counter([(1, "a", None), (2, "b", 0), (3, None, 1)])
    assert rows_of(pending(x.select("k"), y, ["k"])) == Counter([(1,)])


def test_vectors_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "a int, b double")
    with pytest.raises(Exception, match="null"):
        assemble(df, ["a", "b"]).collect()
    assert assemble(df, ["a", "b"], invalid="skip").count() == 1
    assert assemble(df, ["a", "b"], invalid="keep").count() == 2


def test_composites_of_the_survey(spark):
    names = sorted({w for text in HEALTH_COMPOSITES.values() for w in text.replace("(", " ").replace(")", " ").split() if w[0].isalpha()})
    df = spark.createDataFrame([tuple([1] * len(names))], names)
    row = composite_features(df).head()
    assert (row["Diet"], row["cardiovascular"], row["unhealthy_behavior"], row["healthcare"]) == (2, 3, 2, 1)


def test_small_column_operators(spark):
    df = spark.createDataFrame([(1, 0, 5), (2, 1, 6), (3, None, 7)], "k int, label int, v int")
    x, y = split_xy(df, "label", "k")
    assert (x.columns, y.columns) == (["k", "v"], ["k", "label"])
    assert split_xy(df, "label")[1].columns == ["label"]
    assert filter_not(df, F.col("label") == 1).count() == 1
    assert rename_all(df, ["a", "b", "c"]).columns == ["a", "b", "c"]
    assert union_classes(df, df).count() == 6


def test_positions_follow_file_names_not_sizes(spark, tmp_path):
    sizes = {"x": [5, 300, 40], "y": [200, 5, 140]}
    for name, parts in sizes.items():
        first = 0
        for i, n in enumerate(parts):
            rows = spark.range(first, first + n, 1, 1)
            rows.select(F.col("id").alias(name)).write.parquet(f"{tmp_path}/{name}/piece={i}")
            first += n
    x, y = (spark.read.parquet(f"{tmp_path}/{n}").select(n) for n in sizes)
    found = align_by_position(x, y)
    assert found.count() == 345 and found.filter("x <> y").count() == 0


def test_unequal_lengths_are_refused(spark):
    with pytest.raises(ValueError, match="10 rows cannot be paired with 7"):
        align_by_position(spark.range(10).toDF("a"), spark.range(7).toDF("b"))


def test_lookup_spreads_hot_rows_without_random_numbers(spark):
    rows = spark.range(4_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    marked = with_group_facts(rows, ["k"], {"n": F.count(F.lit(1))})
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert "rand(" not in plan
    assert {(r["k"], r["n"]) for r in marked.collect()} == {(0, 1334), (1, 1333), (2, 1333)}
