"""The given star-schema tables mapped to products, customers, lines and nested documents.

The given data is clean, so lines without quantity, with zero or negative quantity, and of
unknown products are derived from line attributes; every row of every table takes part.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.dates import format_order_time
from daybook.operators.lines import validate_lines
from daybook.schemas import MONEY
from daybook.sources.files import row_id

ROWS_PER_BLOCK = 1024
VERSIONS, FIRST_DAY = 4, "1995-01-01"

# The columns that are used; with them given, opening a table runs no job to infer its schema.
COLUMNS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string",
    "events": "ts timestamp_ntz, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast(MONEY)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_brand").alias("product_subcategory"),
        price.alias("sales_price"),
        (price * F.lit(Decimal("0.6"))).cast(MONEY).alias("cost_to_make"),
        F.col("p_size").alias("stock"),
        (F.col("p_partkey") % 500).cast("int").alias("opening_stock"),
    )


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each product's price and stock change on days of its own; one in seven is listed from its second
    version on, so its first lines have none."""
    n = F.explode(F.sequence(F.lit(0), F.lit(VERSIONS - 1))).alias("n")
    days = (F.col("product_id") * 37 + F.col("n") * F.col("n") * 211) % 2400
    price = (F.col("sales_price") + F.col("n") * 7).cast(MONEY)
    return (
        products(spark, sf_dir).select("*", n).filter("n > 0 OR product_id % 7 > 0").select(
            "product_id", "product_name", F.date_add(F.lit(FIRST_DAY).cast("date"), days.cast("int")).alias("valid_from"),
            price.alias("sales_price"), (price * F.lit(Decimal("0.6"))).cast(MONEY).alias("cost_to_make"),
            (F.col("stock") - F.col("n") * 3).alias("stock"),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat_ws(", ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("address"),
    )


def orders(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("batch_date"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_datetime"),
        *extra,
    )


def order_items(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """Line items without their order's header, as they are stored."""
    number, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    unknown = (number == 4) & (F.col("l_returnflag") == "A")
    returned = (number == 5) & (F.col("l_returnflag") == "R")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.when(unknown, -1 - F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("product_id"),
        F.when(number == 7, None)
        .when(number == 6, 0)
        .when(returned, -quantity)
        .otherwise(quantity)
        .alias("quantity"),
        *extra,
    )


def lines(spark: SparkSession, sf_dir: str, row_ids: bool = False) -> DataFrame:
    """Line items with their order's header, and with row ids on request."""
    items = order_items(spark, sf_dir, *([row_id()] if row_ids else []))
    return items.join(orders(spark, sf_dir), "order_id")


def validated(
    spark: SparkSession, sf_dir: str, row_ids: bool = False, all_lines: bool = False
) -> DataFrame:
    return validate_lines(lines(spark, sf_dir, row_ids), products(spark, sf_dir), all_lines)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents. One order may span several: a document takes its items from one block of
    stored rows, so none can grow beyond the block however many lines an order has."""
    block = F.floor(F.col("_metadata.row_index") / ROWS_PER_BLOCK)
    stored = order_items(
        spark, sf_dir, F.col("_metadata.file_name").alias("file"), block.alias("block")
    )
    names = products(spark, sf_dir).select("product_id", "product_name")
    item = F.struct("product_id", "product_name", F.col("quantity").alias("qty"))
    return (
        stored.join(names, "product_id", "left")
        .groupBy("order_id", "file", "block")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .join(orders(spark, sf_dir), "order_id")
        .select(
            "batch_date",
            F.col("order_id").alias("transaction_id"),
            "customer_id",
            format_order_time(F.col("order_datetime")).alias("timestamp"),
            "items",
        )
    )


def drifting_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested documents as JSON text whose fields drift with product and order: ids and quantities as
    text, whole quantities with a fraction, quantities in words, items that are a bare number."""
    product, quantity = F.col("item.product_id"), F.col("item.qty").cast("string")
    number = product.cast("string")
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    in_words = (F.col("transaction_id") % 11 == 0) & (product % 4 == 0)
    qty = (
        F.when(in_words, F.lit('"lots"')).when(quantity.isNull(), F.lit("null"))
        .when(product % 3 == 1, quoted(quantity)).when(product % 3 == 2, F.concat(quantity, F.lit(".0"))).otherwise(quantity)
    )
    item = F.concat(
        F.lit('{"product_id":'), F.when(product % 5 == 0, quoted(number)).otherwise(number), F.lit(',"qty":'), qty, F.lit("}")
    )
    bare = (F.col("transaction_id") % 13 == 0) & (product % 6 == 0)
    exploded = transactions(spark, sf_dir).select(
        "batch_date", "transaction_id", "customer_id", "timestamp", F.xxhash64("items").alias("document"), F.explode("items").alias("item")
    )
    texts = exploded.withColumn("text", F.when(bare, number).otherwise(item))
    keys = ["batch_date", "transaction_id", "customer_id", "timestamp", "document"]
    return texts.groupBy(*keys).agg(F.collect_list("text").alias("texts")).select(
        F.format_string(
            '{"batch_date":"%s","transaction_id":%d,"customer_id":"%d","timestamp":"%s","items":[%s]}',
            F.col("batch_date").cast("string"), "transaction_id", "customer_id", "timestamp", F.array_join("texts", ","),
        ).alias("value")
    )


def overlapping_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the first of every month with orders, two and a half months of days."""
    month = F.trunc("batch_date", "month").alias("first_day")
    return orders(spark, sf_dir).select(month).distinct().select("first_day", F.date_add("first_day", 75).alias("last_day"))


def month_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of days, with the month that each closes."""
    days = orders(spark, sf_dir).select("batch_date").distinct()
    return days.select("batch_date", (F.last_day("batch_date") == F.col("batch_date")).alias("closes_month"))
