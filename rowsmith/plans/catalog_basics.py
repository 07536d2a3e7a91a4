"""Sources, projections, filters, vectors, unions and plain joins."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.functions.expressions import hash_below, tidy
from rowsmith.operators.align import align, align_by_position, align_outer, with_position
from rowsmith.operators.columns import (
    assemble,
    composite_features,
    drop_columns,
    filter_class,
    filter_not,
    rename_all,
    select_columns,
    split_xy,
    union_classes,
    with_row_id,
)
from rowsmith.operators.resample import SPLIT_SEED
from rowsmith.plans.inputs import LABEL_SQL, LINE_FEATURES, LINE_SQL, PREP_FEATURES, PREP_SQL, line, outcome, prep
from rowsmith.plans.registry import query
from rowsmith.session import scratch_path
from rowsmith.sources.tables import load_table, read_table_csv, write_table_csv

_LINE_TYPES = "l_quantity double, l_discount double, l_tax double, l_linenumber int, label int"


@query("s1_read_table_csv", f"WITH {LINE_SQL} SELECT * FROM line")
def s1(spark: SparkSession, folder: str) -> DataFrame:
    path = write_table_csv(line(spark, folder), scratch_path(spark, "csv"))
    return read_table_csv(spark, path, _LINE_TYPES)


@query(
    "s2_write_table_csv",
    f"""WITH {LABEL_SQL} SELECT label, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
        FROM outcome GROUP BY label""",
)
def s2(spark: SparkSession, folder: str) -> DataFrame:
    """The label table through a CSV folder of sixteen parts."""
    path = write_table_csv(outcome(spark, folder), scratch_path(spark, "csv"), parts=16)
    rows = read_table_csv(spark, path, "o_orderkey bigint, label int")
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


@query("p1_select_columns", "SELECT l_quantity, l_tax FROM lineitem")
def p1(spark: SparkSession, folder: str) -> DataFrame:
    return select_columns(load_table(spark, folder, "lineitem"), ["l_quantity", "l_tax"])


@query("p2_drop_columns", f"WITH {PREP_SQL} SELECT month, priority, region5, label FROM prep")
def p2(spark: SparkSession, folder: str) -> DataFrame:
    return drop_columns(prep(spark, folder), ["o_orderkey", "price", "acctbal"])


@query(
    "p3_with_row_id",
    """SELECT count(*) AS n, count(*) AS ids, CAST(0 AS BIGINT) AS first_position,
              count(*) - 1 AS last_position, count(*) AS positions FROM lineitem""",
)
def p3(spark: SparkSession, folder: str) -> DataFrame:
    """Gate: ids are unique, and positions are 0..n-1 without a gap."""
    rows = with_row_id(with_position(load_table(spark, folder, "lineitem").select("l_orderkey")))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("row_id").alias("ids"),
        F.min("position").alias("first_position"),
        F.max("position").alias("last_position"),
        F.count_distinct("position").alias("positions"),
    )


_SHORT = ["id", "a", "b", "c", "d", "e", "y"]


@query(
    "p8_rename_all",
    f"WITH {PREP_SQL} SELECT "
    + ", ".join(f"{old} AS {new}" for old, new in zip(["o_orderkey", *PREP_FEATURES, "label"], _SHORT))
    + " FROM prep",
)
def p8(spark: SparkSession, folder: str) -> DataFrame:
    return rename_all(prep(spark, folder).select("o_orderkey", *PREP_FEATURES, "label"), _SHORT)


@query("p4_filter_class", f"WITH {LABEL_SQL} SELECT * FROM outcome WHERE label = 1")
def p4(spark: SparkSession, folder: str) -> DataFrame:
    return filter_class(outcome(spark, folder), "label", 1)


@query(
    "p4_filter_not",
    """SELECT documents.doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
       WHERE NOT quality = 1""",
)
def p4_not(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are not good; those without a judgement are in neither part."""
    documents = load_table(spark, folder, "documents").select("doc_id")
    judged = documents.join(
        load_table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    return filter_not(judged, F.col("quality") == 1)


@query("p5_split_x", f"WITH {PREP_SQL} SELECT o_orderkey, {', '.join(PREP_FEATURES)} FROM prep")
def p5_x(spark: SparkSession, folder: str) -> DataFrame:
    return split_xy(prep(spark, folder), "label", "o_orderkey")[0]


@query("p5_split_y", f"WITH {PREP_SQL} SELECT o_orderkey, label FROM prep")
def p5_y(spark: SparkSession, folder: str) -> DataFrame:
    return split_xy(prep(spark, folder), "label", "o_orderkey")[1]


@query(
    "p6_assemble",
    f"""WITH {PREP_SQL} SELECT o_orderkey, 5 AS size,
        round(price + month + priority + acctbal + region5, 4) + 0.0 AS total FROM prep""",
)
def p6(spark: SparkSession, folder: str) -> DataFrame:
    parts = vector_to_array("features")
    total = F.aggregate(parts, F.lit(0.0), lambda sum_, part: sum_ + part)
    return assemble(prep(spark, folder), PREP_FEATURES).select(
        "o_orderkey", F.size(parts).alias("size"), tidy(total, 4).alias("total")
    )


@query(
    "p7_composite_features",
    f"""WITH {PREP_SQL} SELECT o_orderkey, priority + region5 AS burden,
        month + (1 - label) AS openness FROM prep""",
)
def p7(spark: SparkSession, folder: str) -> DataFrame:
    spec = {"burden": "priority + region5", "openness": "month + (1 - label)"}
    return composite_features(prep(spark, folder), spec).select("o_orderkey", *spec)


@query("u1_union_classes", f"WITH {PREP_SQL} SELECT * FROM prep")
def u1(spark: SparkSession, folder: str) -> DataFrame:
    rows = prep(spark, folder)
    return union_classes(filter_class(rows, "label", 0), filter_class(rows, "label", 1))


@query(
    "j1_align_outer",
    "SELECT doc_id, n_chars, quality, toxic FROM documents FULL JOIN labels USING (doc_id)",
)
def j1(spark: SparkSession, folder: str) -> DataFrame:
    x = load_table(spark, folder, "documents").select("doc_id", "n_chars")
    return align_outer(x, load_table(spark, folder, "labels"), "doc_id")


@query(
    "j2_align",
    "SELECT doc_id, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def j2(spark: SparkSession, folder: str) -> DataFrame:
    x = load_table(spark, folder, "documents").select("doc_id", "n_chars")
    return align(x, load_table(spark, folder, "labels"), "doc_id")


@query("j2_align_by_position", f"WITH {LINE_SQL} SELECT * FROM line")
def j2_position(spark: SparkSession, folder: str) -> DataFrame:
    """Features and label without a key, put together again by their places."""
    rows = line(spark, folder)
    return align_by_position(rows.select(*LINE_FEATURES), rows.select("label"))


@query("j2_align_by_position_files", f"WITH {LINE_SQL} SELECT * FROM line")
def j2_files(spark: SparkSession, folder: str) -> DataFrame:
    """Features and label stored as five and three folders of unequal sizes, each of sorted files, in one order."""
    rows = with_position(line(spark, folder))
    last = rows.agg(F.max("position")).head()[0] or 0
    read = []
    for cols, parts in ((LINE_FEATURES, 5), (["label"], 3)):
        # Small and large files in turn: Spark deals them out by size, not by name.
        bounds = [last * (2 * i - (i % 2)) // (2 * parts) for i in range(1, parts)]
        part = F.lit(0)
        for bound in bounds:
            part = part + (F.col("position") > bound).cast("int")
        path = scratch_path(spark, "parts")
        dealt = rows.withColumn("part", part)
        for i in range(parts):
            piece = dealt.filter(F.col("part") == i).repartitionByRange("position").sortWithinPartitions("position")
            piece.select(*cols).write.parquet(f"{path}/piece-{i}")
        read.append(spark.read.parquet(*[f"{path}/piece-{i}" for i in range(parts)]))
    return align_by_position(*read)


@query(
    "j3_paired_split",
    f"""WITH {PREP_SQL} SELECT o_orderkey, price, label,
        CASE WHEN CAST('0x' || substr(md5(o_orderkey || ':1234'), 1, 8) AS BIGINT)
                  < 0.8 * 4294967296 THEN 'train' ELSE 'test' END AS part
        FROM prep""",
)
def j3(spark: SparkSession, folder: str) -> DataFrame:
    """Features joined to labels by key before the split: every row keeps its own label and
    there are as many rows as before, not features x labels."""
    x, y = split_xy(prep(spark, folder).select("o_orderkey", "price", "label"), "label", "o_orderkey")
    # One pass: the part is a column, not two filters and a union.
    in_train = hash_below("o_orderkey", SPLIT_SEED, 0.8)
    return align(x, y, "o_orderkey").withColumn("part", F.when(in_train, "train").otherwise("test"))
