"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "row"
# Fixed value: what separates words, ASCII space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one struct beside working columns, so that no name can clash."""
    return df.select(F.struct("*").alias(ROW), *(c.alias(n) for n, c in columns.items()))


def unpacked(df: DataFrame, like: DataFrame, **columns: Column) -> DataFrame:
    """The columns of ``like`` again, and new columns, which replace columns of the same name."""
    taken = {name.lower() for name in columns}
    kept = [F.col(ROW)[n].alias(n) for n in like.columns if n.lower() not in taken]
    return df.select(*kept, *(c.alias(n) for n, c in columns.items()))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else, unlike ``lower``."""
    return F.translate(text, UPPER, LOWER)


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one number, which sizes partitions."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts_of(total: int, each: int) -> int:
    """So many partitions that each holds about ``each`` of the total."""
    return max(1, math.ceil(total / each))
