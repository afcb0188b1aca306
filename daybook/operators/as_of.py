"""The version of a catalogue that held on the day of each line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.lines import line_amounts, per_unit, requested
from daybook.operators.running import BLOCK, in_blocks
from daybook.schemas import ROW_ID

VALID_FROM = "valid_from"
ROW, VERSION = "row_as_it_was", "version"


def as_of(rows: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str = VALID_FROM) -> DataFrame:
    """``rows`` with ``version``, a struct of the other columns of the last of ``versions`` of the same
    ``key`` whose ``valid_from`` is not after ``at``; null where there is none.

    Of versions that begin together the greatest holds, columns compared from left to right. A version
    without a day has always held, before all others; a row without a day takes that one only. A null key
    has no version. Rows and versions are laid out in one order, by key and day, and cut into blocks; the
    last version of each block is carried into the next ones, and within a block from row to row. So a
    key with very many rows is spread over blocks, and no row is paired with more than one version.
    """
    columns = [c for c in versions.columns if c not in (key, valid_from)]
    spread = F.col(ROW_ID) if ROW_ID in rows.columns else F.xxhash64(*rows.columns)
    kind = versions.select(F.struct(*columns).alias(VERSION)).schema[VERSION].dataType
    whole = rows.select(F.struct("*").alias(ROW)).schema[ROW].dataType
    laid = rows.select(
        F.col(key).alias("k"), F.col(at).alias("day"), F.lit(1).alias("after"), spread.alias("tie"),
        F.struct("*").alias(ROW), F.lit(None).cast(kind).alias(VERSION),
    ).unionByName(
        versions.select(
            F.col(key).alias("k"), F.col(valid_from).alias("day"), F.lit(0).alias("after"),
            F.lit(0).cast("bigint").alias("tie"), F.lit(None).cast(whole).alias(ROW), F.struct(*columns).alias(VERSION),
        ).filter("k IS NOT NULL")
    )
    order = ["day", "after", "tie"]  # nulls first
    blocks = in_blocks(laid, ["k"], order)
    newest = F.max(F.when(F.col("after") == 0, F.struct("day", VERSION))).alias("newest")
    ends = blocks.groupBy("k", BLOCK).agg(newest)
    earlier = Window.partitionBy("k").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("k").alias("of_k"), F.col(BLOCK).alias("of_block"),
        F.last(f"newest.{VERSION}", ignorenulls=True).over(earlier).alias("carried"),
    )
    within = Window.partitionBy("k", BLOCK).orderBy("day", "after", VERSION, "tie").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    same = F.col("k").eqNullSafe(F.col("of_k")) & (F.col(BLOCK) == F.col("of_block"))
    found = blocks.withColumn("own", F.last(VERSION, ignorenulls=True).over(within)).filter("after = 1")
    return found.join(carried, same).select(f"{ROW}.*", F.coalesce("own", "carried").alias(VERSION))


def validate_lines_as_of(lines: DataFrame, versions: DataFrame, all_lines: bool = False) -> DataFrame:
    """The same as :func:`daybook.operators.lines.validate_lines`, each line with the price, cost and stock
    that its product had on the day of its batch. ``versions`` is a catalogue with ``valid_from``."""
    kept = lines if all_lines else requested(lines)
    needed, exact = per_unit(versions)
    priced = as_of(kept, versions.select("product_id", VALID_FROM, *needed), "product_id", "batch_date")
    return line_amounts(priced.select(*kept.columns, f"{VERSION}.*"), F.col("quantity") <= F.col("stock"), exact)


def latest(versions: DataFrame, until: Column | None = None) -> DataFrame:
    """One row a product: its last version, of those that begin up to ``until``, without ``valid_from``."""
    if until is not None:
        versions = versions.filter(F.col(VALID_FROM).isNull() | (F.col(VALID_FROM) <= until))
    columns = [c for c in versions.columns if c not in ("product_id", VALID_FROM)]
    last = F.max(F.struct(F.col(VALID_FROM), *columns)).alias("last")
    found = versions.groupBy("product_id").agg(last)
    order = [c for c in versions.columns if c != VALID_FROM]
    return found.select("product_id", *(F.col("last")[c].alias(c) for c in columns)).select(*order)
