"""Order lines: explode, look up, cancel what stock cannot cover, price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import parse_order_time
from daybook.functions.money import cents, from_cents, holds_whole_cents
from daybook.schemas import ROW_ID, TOTAL


def explode_items(transactions: DataFrame) -> DataFrame:
    """One row per item; documents whose ``items`` is missing or empty give none.

    ``batch_date`` falls back to the day of the order where a document carries none. ``row_id`` is
    made of the document and the place in it, so the lines of one order can be told apart.
    """
    moment = parse_order_time(F.col("timestamp"))
    day = F.to_date(moment)
    if "batch_date" in transactions.columns:
        day = F.coalesce("batch_date", day)
    items = transactions.select(
        day.alias("batch_date"),
        F.col("transaction_id").alias("order_id"),
        "customer_id",
        moment.alias("order_datetime"),
        F.xxhash64("transaction_id", "customer_id", "timestamp", day).alias("document"),
        F.posexplode("items").alias("place", "item"),
    )
    return items.select(
        "batch_date",
        "order_id",
        "customer_id",
        "order_datetime",
        F.col("item.product_id").alias("product_id"),
        F.col("item.product_name").alias("product_name"),
        F.col("item.qty").alias("quantity"),
        F.xxhash64("document", "place").alias(ROW_ID),
    )


def tie_break(rows: DataFrame) -> list[str]:
    """Keys to append to an ordering, where the rows carry an identity."""
    return [ROW_ID] if ROW_ID in rows.columns else []


def requested(lines: DataFrame) -> DataFrame:
    """Lines that ask for a quantity at all."""
    return lines.filter(F.col("quantity").isNotNull())


def with_catalogue(lines: DataFrame, products: DataFrame, *extra: Column) -> DataFrame:
    """Price, cost, stock and ``extra`` per line; lines of unknown products stay, with nulls.

    No hint: Spark broadcasts the catalogue while it is under the size threshold and otherwise
    shuffles, splitting the partitions of hot products at run time.
    """
    price = F.col("sales_price").alias("unit_price")
    catalogue = products.select("product_id", price, "cost_to_make", "stock", *extra)
    return lines.join(catalogue, "product_id", "left")


def per_unit(products: DataFrame) -> tuple[list[Column], bool]:
    """What a line needs of its product: price, cost, stock, and amounts of one unit. Also whether those
    are whole cents, taken once per product, so that a line costs one multiplication of integers."""
    price, cost = F.col("sales_price"), F.col("cost_to_make")
    kinds = [products.schema[name].dataType for name in ("sales_price", "cost_to_make")]
    exact = all(holds_whole_cents(kind) for kind in kinds)
    unit, margin = (cents(price), cents(price - cost)) if exact else (price, price - cost)
    return [price.alias("unit_price"), cost, F.col("stock"), unit.alias("per_unit"), margin.alias("margin")], exact


def line_amounts(priced: DataFrame, filled: Column, exact: bool) -> DataFrame:
    """``final_quantity`` where ``filled`` holds, and amounts in cents, in place of those of one unit."""

    def amount(of_unit: str) -> Column:
        quantity = F.col("final_quantity")
        if exact:
            return quantity.cast("bigint") * F.col(of_unit)
        return cents(F.round(quantity * F.col(of_unit), 2).cast(TOTAL))

    return (
        priced.withColumn("final_quantity", F.when(filled, F.col("quantity")))
        .withColumns({"line_cents": amount("per_unit"), "profit_cents": amount("margin")})
        .drop("per_unit", "margin")
    )


def with_line_amounts(lines: DataFrame, products: DataFrame, filled: Column) -> DataFrame:
    """Adds the catalogue's columns, ``final_quantity`` where ``filled`` holds, and amounts in cents."""
    needed, exact = per_unit(products)
    return line_amounts(with_catalogue(lines, products, *needed[3:]), filled, exact)


def validate_lines(lines: DataFrame, products: DataFrame, all_lines: bool = False) -> DataFrame:
    """Lines with ``final_quantity``, ``line_cents`` and ``profit_cents``, for all days at once.

    A line whose quantity exceeds the product's stock, or whose product is unknown, keeps its row
    with null quantity and amounts. Each line is checked against the full stock on its own. Amounts
    are rounded per line and kept whole; one beyond a long number of cents raises. Lines that ask
    for no quantity are left out, or kept like cancelled ones with ``all_lines``.
    """
    kept = lines if all_lines else requested(lines)
    return with_line_amounts(kept, products, F.col("quantity") <= F.col("stock"))


def with_amounts(validated: DataFrame) -> DataFrame:
    """Adds ``line_total`` and ``profit`` as decimals."""
    return validated.withColumns(
        {
            "line_total": from_cents(F.col("line_cents")),
            "profit": from_cents(F.col("profit_cents")),
        }
    )


def cancelled_item_count(validated: DataFrame) -> DataFrame:
    return validated.agg(F.count_if(F.col("final_quantity").isNull()).alias("cancelled_items"))
