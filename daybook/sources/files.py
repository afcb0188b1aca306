"""File readers. Every reader takes an explicit schema, so no inference pass runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """CSV with a header line that must match the schema; quoted fields may hold commas, doubled
    quotes and line breaks. Without ``multi_line`` a large file is read by many tasks, but a line
    break inside a field then splits the row."""
    reader = spark.read.schema(schema).options(**schemas.CSV_OPTIONS)
    return reader.option("enforceSchema", False).option("multiLine", multi_line).csv(path)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMERS)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.PRODUCTS)


def row_id() -> Column:
    """Identity of a row stored in Parquet: the same however often and wherever it is read.

    Added as column ``row_id``, it lets sorts and running totals spread copies of one row.
    """
    return F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(schemas.ROW_ID)
