"""Stock after sales: in total, as a report, and as a running balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.money import floor_at_zero
from daybook.operators.lines import tie_break
from daybook.operators.running import running_total

# Fixed value: one line of the inventory report.
REPORT_LINE = "• %-30s (ID: %3d): %4d units"


def ordered_per_product(lines: DataFrame, quantity: str = "final_quantity") -> DataFrame:
    """Units per product; summed before the shuffle, so a hot product stays cheap."""
    return lines.groupBy("product_id").agg(F.sum(quantity).alias("total_ordered"))


def update_inventory(products: DataFrame, validated: DataFrame, stock: str = "stock") -> DataFrame:
    """Stock left per product, never below zero; products without sales keep their stock."""
    left = F.col(stock) - F.coalesce(F.col("total_ordered"), F.lit(0))
    return (
        products.join(ordered_per_product(validated), "product_id", "left")
        .select("product_id", "product_name", floor_at_zero(left).cast("bigint").alias("current_stock"))
        .orderBy("product_id")
    )


def inventory_report(stock_levels: DataFrame) -> DataFrame:
    """One formatted text line per product, by product."""
    line = F.format_string(REPORT_LINE, "product_name", "product_id", "current_stock")
    return stock_levels.orderBy("product_id").select("product_id", line.alias("report_line"))


def running_inventory(
    products: DataFrame, validated: DataFrame, stock: str = "stock", reload_daily: bool = False
) -> DataFrame:
    """Balance after every fulfilled line, in order of day and order id.

    ``reload_daily`` starts every day from the full stock again; otherwise it carries over.
    """
    ties = tie_break(validated)
    sold = validated.filter(F.col("final_quantity") > 0).select(
        "product_id", "batch_date", "order_id", F.col("final_quantity").alias("quantity"), *ties
    )
    group, order = ["product_id"], ["batch_date", "order_id", "quantity", *ties]
    if reload_daily:
        group, order = group + order[:1], order[1:]
    demand = running_total(sold, group, order, "quantity", "ordered_so_far")
    opening = products.select("product_id", F.col(stock).alias("opening"))
    left = F.col("opening") - F.col("ordered_so_far")
    return demand.join(opening, "product_id").select(
        "product_id",
        "batch_date",
        "order_id",
        "quantity",
        "ordered_so_far",
        floor_at_zero(left).cast("bigint").alias("remaining_stock"),
    )
