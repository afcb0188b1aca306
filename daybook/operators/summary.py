"""Daily roll-up, table profile and previews."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.money import from_cents
from daybook.operators.orders import order_totals, valid


def summarise(totals: DataFrame) -> DataFrame:
    """Orders, sales and profit per day, by date, from the totals per order."""
    return (
        valid(totals)
        .groupBy("date")
        .agg(
            F.count("*").alias("num_orders"),
            from_cents(F.sum("sales")).alias("total_sales"),
            from_cents(F.sum("profit")).alias("total_profit"),
        )
        .orderBy("date")
    )


def daily_summary(validated: DataFrame) -> DataFrame:
    """Orders, sales and profit per day, by date.

    Two aggregations: per order, keeping the valid ones, then per day. No join back to the lines
    and no distinct count, since the first level already holds one row per order.
    """
    return summarise(order_totals(validated))


def distinct_orders_per_day(validated: DataFrame) -> DataFrame:
    return validated.groupBy("batch_date").agg(F.count_distinct("order_id").alias("num_orders"))


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    profiles = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, profiles)


def preview(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """First ``n`` rows by key."""
    return df.orderBy(*keys).limit(n)
