"""Dates, order timestamps and calendar spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.schemas import ISO_MICROS

DAY_CODE = "yyyyMMdd"


def parse_order_time(text: Column) -> Column:
    """Order timestamp from text, without time zone; null where the text is not a timestamp."""
    return text.try_cast("timestamp_ntz")


def format_order_time(moment: Column) -> Column:
    return F.date_format(moment, ISO_MICROS)


def day_code(day: Column) -> Column:
    return F.date_format(day, DAY_CODE)


def date_spine(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Every date from column ``first`` to column ``last`` inclusive, with its yyyyMMdd code.

    A row whose first date is after its last date gives no dates.
    """
    a, b = F.col(first), F.col(last)
    return (
        bounds.filter(a <= b)
        .select(F.explode(F.sequence(a, b, F.expr("interval 1 day"))).alias("date"))
        .distinct()
        .select("date", day_code(F.col("date")).alias("day_code"))
    )
