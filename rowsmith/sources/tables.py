"""Tables on disk: Parquet inputs and CSV folders with a header in every part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_table_csv(
    spark: SparkSession, path: str, schema: StructType | str, mode: str = "FAILFAST"
) -> DataFrame:
    """Read a folder of CSV parts. The schema is given, so no pass is spent on inference.

    Header names are checked against the schema part by part; a bad field fails the read
    unless ``mode`` asks for something softer.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", mode)
        .csv(path)
    )


def write_table_csv(df: DataFrame, path: str, parts: int | None = None, mode: str = "errorifexists") -> str:
    """Write one CSV file per partition, each with its own header, and return the path.

    ``parts`` asks for that many files. It redistributes the rows instead of merging
    partitions, so the work before the write keeps its parallelism.
    """
    if parts is not None:
        df = df.repartition(parts)
    df.write.option("header", True).mode(mode).csv(path)
    return path
