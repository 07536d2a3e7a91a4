from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsmith.operators.align import lookup, mark_repeated, semi_join, with_group_facts
from rowsmith.operators.quality import (
    between,
    clean,
    drop_contradictions,
    drop_exact_duplicates,
    health_survey_rules,
    invalid_rows,
    one_of,
    validity_report,
)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_contradiction_with_a_label_seen_once(spark):
    df = spark.createDataFrame([(2, 0), (2, 1), (3, 1)], "x int, label int")
    assert rows_of(clean(df, ["x"], "label")) == Counter([(3, 1)])
    df = spark.createDataFrame([(1, 0), (1, 0), (4, 9)], "x int, label int")
    assert rows_of(clean(df, ["x"], "label")) == Counter([(1, 0), (4, 9)])


def test_null_label_is_a_value(spark):
    df = spark.createDataFrame(
        [(1, None), (1, None), (2, None), (2, 1), (None, 1), (None, 1)], "x int, label int"
    )
    expected = Counter([(1, None), (None, 1)])
    assert rows_of(clean(df, ["x"], "label")) == expected
    kept = drop_contradictions(df, ["x"], "label")
    assert rows_of(kept) == Counter([(1, None)] * 2 + [(None, 1)] * 2)


def test_copies_with_nulls_are_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1)], "x int, label int")
    assert drop_exact_duplicates(df).count() == 2


@pytest.mark.parametrize("hot_share", [0.0, 0.05, 1.0])
def test_group_facts_are_the_same_whatever_is_hot(spark, hot_share):
    # One key, null, holds a third of the rows.
    data = [(None if i % 3 == 0 else i % 40, i) for i in range(600)]
    df = spark.createDataFrame(data, "k int, v int").repartition(5)
    found = with_group_facts(df, ["k"], {"low": F.min("v"), "n": F.count("v")}, hot_share)
    groups = {}
    for k, v in data:
        groups.setdefault(k, []).append(v)
    expected = Counter((k, v, min(groups[k]), len(groups[k])) for k, v in data)
    assert rows_of(found) == expected


def test_lookup_keeps_rows_without_a_match(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    table = spark.createDataFrame([(1, "a", 10)], "key int, name string, w int")
    found = lookup(df, table, {"k": "key"}, ["name"], "w")
    assert rows_of(found) == Counter([(1, "a"), (2, None), (None, None)])


def test_mark_repeated(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, None), (None, None)], "a int, b int")
    flags = rows_of(mark_repeated(df, ["a", "b"]))
    assert flags == Counter([(1, 1, True)] * 2 + [(1, 2, False)] + [(None, None, True)] * 2)


def test_semi_join_matches_nulls(spark):
    df = spark.createDataFrame([(None, 1), (2, 2), (3, 3)], "a int, v int")
    kept = spark.createDataFrame([(None,), (3,)], "a int")
    assert rows_of(semi_join(df, kept, ["a"])) == Counter([(None, 1), (3, 3)])


def test_validity_counts_nulls_apart(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, None)], "id int, x int")
    rules = [one_of("x", 0, 1), between("id", 1, 3)]
    assert [tuple(r) for r in validity_report(df, rules).collect()] == [("x", 1, 1), ("id", 1, 0)]
    assert rows_of(invalid_rows(df, rules, "id")) == Counter([(3, "x", 2.0), (4, "id", 4.0)])


def test_health_survey_rules(spark):
    rules = health_survey_rules()
    assert len(rules) == 20 and "BMI" not in {r.column for r in rules}
    good = {r.column: 1 for r in rules}
    bad = {r.column: 99 for r in rules}
    df = spark.createDataFrame([tuple(good.values()), tuple(bad.values())], list(good))
    report = {r["feature"]: r["invalid"] for r in validity_report(df, rules).collect()}
    assert report == {c: 1 for c in good}


def test_results_do_not_depend_on_partitions(spark):
    df = spark.range(500).select((F.col("id") % 37).alias("x"), (F.col("id") % 74 > 40).cast("int").alias("label"))
    for act in (
        lambda d: clean(d, ["x"], "label"),
        lambda d: drop_contradictions(d, ["x"], "label"),
        drop_exact_duplicates,
    ):
        assert rows_of(act(df.repartition(1))) == rows_of(act(df.repartition(7)))
