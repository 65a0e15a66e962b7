"""Partitioned stores and JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def store_raw(df: DataFrame, path: str) -> DataFrame:
    """Write raw records partitioned by split and read them back."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return df.sparkSession.read.parquet(path)


def with_record_id(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with a record_id that any later read finds again: file and row number."""
    stored = spark.read.parquet(path)
    file = F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+)$", 1)
    return stored.withColumn("record_id", F.concat_ws("#", file, F.col("_metadata.row_index").cast("string")))


def store_routed(annotated: DataFrame, path: str) -> DataFrame:
    """Write quarantined rows and first clean copies in one pass, partitioned by route and split."""
    kept = annotated.where((F.col("route") == "quarantine") | F.col("is_survivor"))
    kept.write.mode("overwrite").partitionBy("route", "split").parquet(path)
    return annotated.sparkSession.read.parquet(path)


def scan_store(spark: SparkSession, path: str, split: str | None = None, route: str | None = None) -> DataFrame:
    """A partitioned store; split and route prune whole folders."""
    df = spark.read.parquet(path)
    for column, value in (("split", split), ("route", route)):
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def write_report(df: DataFrame, path: str) -> None:
    """One JSON object per row; nested columns become nested objects."""
    df.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
