"""Orders derived from validated lines."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import format_order_time
from daybook.functions.money import from_cents
from daybook.operators.lines import tie_break
from daybook.schemas import MONEY

ORDER_KEY = ["batch_date", "order_id"]


HEADER = [*ORDER_KEY, "customer_id", "order_datetime"]


def _of_orders(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows whose order is among the chosen ones; a missing day or id is a value like any other."""
    keys = chosen.select(*(F.col(name).alias(f"chosen_{name}") for name in ORDER_KEY))
    same = [F.col(name).eqNullSafe(F.col(f"chosen_{name}")) for name in ORDER_KEY]
    return rows.join(keys, functools.reduce(Column.__and__, same), "left_semi")


def _units_and_amounts() -> list[Column]:
    """Units over all lines, amounts in cents over the positive ones."""
    fulfilled = F.col("final_quantity") > 0
    return [
        F.sum("final_quantity").alias("units"),
        F.sum(F.when(fulfilled, F.col("line_cents"))).alias("sales"),
        F.sum(F.when(fulfilled, F.col("profit_cents"))).alias("profit"),
    ]


def _date() -> Column:
    return F.coalesce(F.to_date(F.min("order_datetime")), F.first("batch_date")).alias("date")


def order_totals(validated: DataFrame) -> DataFrame:
    """One row per order of a day, with units, amounts and the date of the order, which is the day
    of the batch where no time of the order can be read.

    Partial sums run before the shuffle, so an order with very many lines travels as one row per
    map task.
    """
    return validated.groupBy(*ORDER_KEY).agg(*_units_and_amounts(), _date())


def order_headers(validated: DataFrame) -> DataFrame:
    """Distinct order headers with units, amounts and number of lines: all that orders, trading days
    and summary need of the lines, so that a run over many results reads the lines once."""
    cancelled = F.count_if(F.col("final_quantity").isNull()).alias("cancelled")
    return validated.groupBy(*HEADER).agg(*_units_and_amounts(), F.count("*").alias("lines"), cancelled)


def header_totals(headers: DataFrame) -> DataFrame:
    """The same as :func:`order_totals`, from the headers."""
    sums = [F.sum(name).alias(name) for name in ("units", "sales", "profit")]
    return headers.groupBy(*ORDER_KEY).agg(*sums, _date())


def valid(totals: DataFrame) -> DataFrame:
    """Orders whose quantities, negative ones included, sum to more than zero."""
    return totals.filter(F.col("units") > 0)


def valid_orders(validated: DataFrame) -> DataFrame:
    """Valid orders and their units; needs no column but the keys and ``final_quantity``."""
    return valid(validated.groupBy(*ORDER_KEY).agg(F.sum("final_quantity").alias("units")))


def cancelled_orders(all_lines: DataFrame) -> DataFrame:
    """Orders of which nothing is left: quantities sum to zero, cancelled lines and lines without
    quantity counting as zero. Takes lines validated with ``all_lines``."""
    units = F.sum(F.coalesce(F.col("final_quantity"), F.lit(0)))
    return all_lines.groupBy(*ORDER_KEY).agg(units.alias("units")).filter(F.col("units") == 0)


def lines_of_valid_orders(validated: DataFrame) -> DataFrame:
    return _of_orders(validated, valid_orders(validated))


def orders_of(validated: DataFrame) -> DataFrame:
    """Distinct headers of the valid orders."""
    headers = validated.select(*HEADER).distinct()
    return _of_orders(headers, valid_orders(validated))


def orders_of_headers(headers: DataFrame) -> DataFrame:
    """The same as :func:`orders_of`, from the headers."""
    return _of_orders(headers.select(*HEADER), valid(header_totals(headers)))


def trading_days(valid_orders: DataFrame) -> DataFrame:
    """Days with at least one valid order."""
    return valid_orders.select("batch_date").distinct()


def items_of(validated: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Line items of the trading days, cancelled lines included with null quantity.

    The broadcast side is a set of distinct dates, which the calendar bounds whatever the data.
    """
    if days is None:
        days = trading_days(valid_orders(validated))
    open_days = days.select(F.col("batch_date").alias("open_day"))
    traded = F.col("batch_date").eqNullSafe(F.col("open_day"))
    return validated.join(F.broadcast(open_days), traded, "left_semi").select(
        *ORDER_KEY,
        "product_id",
        F.col("final_quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast(MONEY).alias("unit_price"),
        from_cents(F.col("line_cents")).alias("line_total"),
        *tie_break(validated),
    )


def sorted_orders(orders: DataFrame) -> DataFrame:
    """Orders by id with the timestamp as text; the further keys let one id span several tasks."""
    moment = "order_datetime"
    return orders.orderBy("order_id", "customer_id", moment, *tie_break(orders)).withColumn(
        moment, format_order_time(F.col(moment))
    )


def sorted_items(items: DataFrame) -> DataFrame:
    """Fulfilled line items by order and product; row ids let equal keys span several tasks."""
    kept = items.filter(F.col("quantity").isNotNull())
    return kept.orderBy("order_id", "product_id", *tie_break(items))


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(items, "order_id", "inner")


def totals_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with the number and the units of their items; on tables bucketed by order id no row moves."""
    joined = orders_with_items(orders, items)
    return joined.groupBy("order_id").agg(
        F.min("customer_id").alias("customer_id"), F.count("*").alias("num_items"), F.sum("quantity").alias("units")
    )


def orders_with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer's details; orders of unknown customers stay."""
    return orders.join(customers, "customer_id", "left")
