"""Running totals over groups of any size."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import materialise

BLOCK = "block"
BEFORE = "before_block"


def in_blocks(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``block``: rows cut by group and order into consecutive blocks, and written, because
    the borders come from a sample and must not be drawn twice."""
    return materialise(df.repartitionByRange(*group, *order).withColumn(BLOCK, F.spark_partition_id()), "blocks")


def running_total(
    df: DataFrame, group: list[str], order: list[str], value: str, out: str
) -> DataFrame:
    """Sum of ``value`` over each group's rows up to and including the row, in ``order``.

    A plain window puts a whole group into one task. Here the rows are range-partitioned on group
    and order, which cuts a large group into consecutive blocks; each block is summed on its own
    and the blocks before it are added from a table of one row per group and block. The blocks
    are written out first, because their borders come from a sample and must not be drawn twice.
    """
    blocks = in_blocks(df, group, order)
    sums = blocks.groupBy(*group, BLOCK).agg(F.sum(value).alias("block_sum"))
    earlier = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, BLOCK]
    offsets = sums.select(
        *(F.col(name).alias(f"of_{name}") for name in keys),
        F.coalesce(F.sum("block_sum").over(earlier), F.lit(0)).alias(BEFORE),
    )
    same = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in keys]  # a group may be null
    within = (
        Window.partitionBy(*group, BLOCK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        blocks.withColumn(out, F.sum(value).over(within))
        .join(offsets, functools.reduce(Column.__and__, same))
        .withColumn(out, F.col(out) + F.col(BEFORE))
        .drop(BLOCK, BEFORE, *(f"of_{name}" for name in keys))
    )
