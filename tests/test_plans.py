"""The physical plans: what is read, how often rows move, and what must never appear."""

import os
import re

import pytest
from pyspark.sql import functions as F

from rowsmith.operators.align import align
from rowsmith.operators.resample import train_test_split
from rowsmith.plans.registry import all_queries

SMALL = "/root/testdata/sf0.001"
# These run models or whole series of jobs while they are built.
EAGER = ("t", "r1", "s5", "l5")

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def plan(spark, name):
    return all_queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def moves(text):
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", text))


@pytest.mark.parametrize("name", sorted(n for n in all_queries() if not n.startswith(EAGER)))
def test_no_pairs_of_everything_and_no_python_rows(spark, name):
    text = plan(spark, name)
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert forbidden not in text


@pytest.mark.parametrize(
    "name",
    ["p4_filter_class", "v2_invalid_rows", "m1_undersample", "m1_undersample_exact", "m2_oversample", "m3_train_test_split", "m4_kfold", "p6_assemble"],
)
def test_row_wise_operators_do_not_shuffle(spark, name):
    assert moves(plan(spark, name)) == 0


@pytest.mark.parametrize(
    "name", ["q1_drop_exact_duplicates", "q3_clean", "v1_validity_report", "a1_class_counts", "a9_label_correlation"]
)
def test_one_shuffle_after_partial_aggregation(spark, name):
    text = plan(spark, name)
    assert moves(text) == 1
    assert "partial_" in text or text.count("HashAggregate") == 2


@pytest.mark.parametrize(
    "name, columns",
    [
        ("p1_select_columns", "l_quantity:double,l_tax:double"),
        ("a1_class_counts", "o_orderstatus:string"),
        ("a2_count_where", "l_quantity:double,l_tax:double"),
        ("m4_kfold", "o_orderkey:bigint"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name)) == [columns]


def test_filters_reach_the_scan(spark):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan(spark, "a2_count_where"))
    assert "GreaterThan(l_quantity,25.0)" in pushed[0] and "LessThan(l_tax,0.04)" in pushed[0]


def test_split_filter_sinks_below_the_join(spark):
    x, y = (spark.range(100).toDF("key").withColumn(c, F.lit(1)) for c in "xy")
    train, _ = train_test_split(align(x, y, "key"), "key")
    text = train._jdf.queryExecution().executedPlan().toString()
    assert text.index("Join") < text.rindex("md5")


def test_paired_split_reads_each_side_once(spark):
    assert plan(spark, "j3_paired_split").count("FileScan") == 2 * plan(spark, "p5_split_x").count("FileScan")


SCORING = {"t1_fit_score": 1, "t5_naive_bayes": 1}


@pytest.mark.parametrize("name", SCORING)
def test_scoring_does_not_pair_everything(spark, name):
    text = plan(spark, name)
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "InPandas", "InArrow"):
        assert forbidden not in text


@pytest.mark.parametrize(
    "name, times",
    [
        ("q2_drop_contradictions", 2),
        ("w3_mark_repeated", 2),
        ("w2_average_rank_bucketed", 1),
        ("a14_auc_roc_continuous", 1),
        ("m1_undersample_exact", 3),
        ("m2_oversample", 3),
    ],
)
def test_how_often_the_input_is_read(spark, name, times):
    """Rows that all jobs of a query read from the given table, as multiples of its size."""
    table = "lineitem" if name[0] in "qwa" else "orders"
    size = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    before = rows_read(spark, table)
    all_queries()[name](spark, SMALL).write.format("noop").mode("overwrite").save()
    read = rows_read(spark, table) - before
    assert size <= read <= times * size


def rows_read(spark, table):
    """Rows out of the table's scans in all finished executions."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    store = spark._jsparkSession.sharedState().statusStore()
    executions, found = store.executionsList(), 0
    for i in range(executions.size()):
        number = executions.apply(i).executionId()
        values, nodes = store.executionMetrics(number), store.planGraph(number).allNodes()
        for k in range(nodes.size()):
            node = nodes.apply(k)
            if node.name().startswith("Scan") and f"/{table}.parquet" in node.desc():
                for m in range(node.metrics().size()):
                    metric = node.metrics().apply(m)
                    value = values.get(metric.accumulatorId())
                    if metric.name() == "number of output rows" and value.isDefined():
                        found += int(value.get().replace(",", ""))
    return found
