"""One test per business rule, on small hand-made documents."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook import schemas
from daybook.operators import inventory, lines, orders, summary
from tests.conftest import day, document, plain

D = Decimal


def test_lines_without_quantity_are_dropped_before_the_lookup(validate):
    found = validate(document(1, (1, 5), (2, None), (3, 2)))
    assert plain(found, "product_id", "final_quantity") == [(1, 5), (3, 2)]


def test_quantity_up_to_stock_is_kept_and_above_is_cancelled(validate):
    found = validate(document(1, (1, 10), (2, 6)))
    assert plain(found, "product_id", "quantity", "final_quantity", "line_total") == [
        (1, 10, 10, D("25.00")),
        (2, 6, None, None),
    ]


def test_unknown_product_and_unknown_stock_cancel_the_line(validate):
    found = validate(document(1, (99, 1), (4, 1)))
    assert plain(found, "product_id", "final_quantity", "unit_price", "line_total") == [
        (4, None, D("2.50"), None),
        (99, None, None, None),
    ]


def test_each_line_is_checked_against_the_full_stock(validate):
    found = validate(document(1, (1, 8)), document(2, (1, 8)))
    assert plain(found, "order_id", "final_quantity") == [(1, 8), (2, 8)]


def test_zero_quantity_prices_to_zero_but_does_not_make_an_order_valid(validate):
    found = validate(document(1, (1, 0)))
    assert plain(found, "line_total") == [(D("0.00"),)]
    assert plain(orders.valid_orders(found)) == []
    assert plain(orders.cancelled_orders(found), "order_id", "units") == [(1, 0)]


def test_negative_quantities_lower_the_order_sum_and_raise_stock(validate, products):
    found = validate(document(1, (1, 3), (3, -2)), document(2, (1, 1), (3, -1)))
    assert plain(orders.valid_orders(found), "order_id", "units") == [(1, 1)]
    day_row = plain(summary.daily_summary(found), "num_orders", "total_sales", "total_profit")
    assert day_row == [(1, D("7.50"), D("4.50"))]
    stock = dict(plain(inventory.update_inventory(products, found), "product_id", "current_stock"))
    assert stock[3] == 103 and stock[1] == 6


def test_rounding_is_half_up_per_line(spark, validate):
    row = (9, "x", "c", "s", "r", D("0.05"), D("0.03"), 100)
    catalogue = spark.createDataFrame([row], schemas.PRODUCTS)
    found = validate(document(1, (9, 3)), catalogue=catalogue)
    assert plain(found, "line_total", "profit") == [(D("0.15"), D("0.06"))]


def test_prices_finer_than_a_cent_round_per_line(spark, validate, products):
    fine = "cast(sales_price * 0 + {} as decimal(12,4))"
    catalogue = products.filter("product_id = 3").withColumns(
        {"sales_price": F.expr(fine.format("0.3350")), "cost_to_make": F.expr(fine.format("0.0010"))}
    )
    found = validate(document(1, (3, 1), (3, 3)), catalogue=catalogue)
    assert plain(found, "line_total", "profit") == [(D("0.34"), D("0.33")), (D("1.01"), D("1.00"))]


def test_prices_as_doubles_do_not_lose_a_cent(spark, validate):
    row = (9, 0.29, 0.01, 1000)
    catalogue = spark.createDataFrame([row], "product_id long, sales_price double, cost_to_make double, stock int")
    found = validate(document(1, (9, 1), (9, 100)), catalogue=catalogue)
    assert plain(found, "line_total", "profit") == [(D("0.29"), D("0.28")), (D("29.00"), D("28.00"))]


def test_large_amounts_stay_whole(spark, validate):
    row = (9, "x", "c", "s", "r", D("99999999.99"), D("0.01"), 1000)
    catalogue = spark.createDataFrame([row], schemas.PRODUCTS)
    found = validate(document(1, (9, 5), (9, 1000)), catalogue=catalogue)
    assert plain(found, "line_total") == [(D("499999999.95"),), (D("99999999990.00"),)]
    row = plain(summary.daily_summary(found), "num_orders", "total_sales", "total_profit")
    assert row == [(1, D("100499999989.95"), D("100499999979.90"))]


def test_an_amount_beyond_all_cents_raises(spark, validate):
    catalogue = spark.createDataFrame([(9, 10**17, 0, 1000)], "product_id long, sales_price long, cost_to_make long, stock int")
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        validate(document(1, (9, 1000)), catalogue=catalogue).collect()


def test_orders_without_any_quantity_are_fully_cancelled(spark, products):
    nested = [document(1, (1, None), (2, None)), document(2, (1, None), (3, 1)), document(3, (2, 9), (1, None))]
    exploded = lines.explode_items(spark.createDataFrame(nested, schemas.TRANSACTIONS))
    found = orders.cancelled_orders(lines.validate_lines(exploded, products, all_lines=True))
    assert plain(found, "order_id", "units") == [(1, 0), (3, 0)]


def test_orders_and_items_of_documents_without_a_day(spark, products):
    """A day column that is null in some documents, and an order of no day at all."""
    nested = [document(1, (1, 1)), document(2, (1, 1)), document(3, (1, 2), moment="never")]
    documents = spark.createDataFrame(nested, schemas.TRANSACTIONS).withColumn(
        "batch_date", F.when(F.col("transaction_id") == 2, F.lit("2024-02-09").cast("date"))
    )
    found = lines.validate_lines(lines.explode_items(documents), products)
    days = [(None, 3), (day("2024-02-09"), 2), (day("2024-03-01"), 1)]
    assert plain(orders.orders_of(found), "batch_date", "order_id") == days
    assert plain(orders.orders_of_headers(orders.order_headers(found)), "batch_date", "order_id") == days
    assert plain(orders.items_of(found), "batch_date", "order_id") == days
    assert plain(orders.lines_of_valid_orders(found), "batch_date", "order_id") == days
    for reload_daily in (False, True):
        left = inventory.running_inventory(products, found, reload_daily=reload_daily)
        assert plain(left, "order_id") == [(1,), (2,), (3,)]


def test_missing_and_empty_items_give_no_lines(validate):
    assert plain(validate(document(1, None), document(2))) == []


def test_unreadable_timestamp_becomes_null(validate):
    found = validate(document(1, (1, 1), moment="yesterday"), document(2, (1, 1)))
    assert plain(found, "order_id", "order_datetime", "batch_date") == [
        (1, None, None),
        (2, dt.datetime(2024, 3, 1, 9, 30, 0, 1), day("2024-03-01")),
    ]


def test_cancelled_lines_stay_in_items_and_invalid_orders_too(validate):
    found = validate(document(1, (1, 2), (2, 6)), document(2, (2, 6)))
    assert plain(orders.items_of(found), "order_id", "product_id", "quantity") == [
        (1, 1, 2),
        (1, 2, None),
        (2, 2, None),
    ]
    assert plain(orders.orders_of(found), "order_id") == [(1,)]
    assert plain(orders.cancelled_orders(found), "order_id") == [(2,)]
    assert plain(lines.cancelled_item_count(found)) == [(2,)]


def test_day_without_valid_order_gives_neither_orders_nor_items(validate):
    found = validate(
        document(1, (1, 2)), document(2, (2, 6), (1, 0), moment="2024-03-02T10:00:00.000000")
    )
    assert plain(orders.items_of(found), "batch_date").count((day("2024-03-02"),)) == 0
    assert plain(orders.orders_of(found), "batch_date") == [(day("2024-03-01"),)]
    assert plain(summary.daily_summary(found), "date") == [(day("2024-03-01"),)]


def test_repeated_lines_of_an_order_stay_separate(validate):
    found = validate(document(1, (1, 2), (1, 2)), document(1, (1, 2), (1, 2)))
    assert plain(orders.items_of(found), "quantity") == [(2,)] * 4
    assert len(plain(orders.orders_of(found))) == 1
    assert plain(summary.daily_summary(found), "num_orders", "total_sales") == [(1, D("20.00"))]


def test_order_id_on_two_days_counts_on_each_without_doubling(validate):
    found = validate(
        document(1, (1, 2)), document(1, (3, 1), moment="2024-03-02T10:00:00.000000")
    )
    rows = plain(summary.daily_summary(found), "date", "num_orders", "total_sales")
    assert rows == [(day("2024-03-01"), 1, D("5.00")), (day("2024-03-02"), 1, D("10.00"))]


def test_two_timestamps_of_one_order_give_two_headers_and_one_order_of_the_day(validate):
    found = validate(document(1, (1, 2)), document(1, (1, 1), moment="2024-03-01T11:00:00.000000"))
    assert len(plain(orders.orders_of(found))) == 2
    assert plain(summary.daily_summary(found), "num_orders", "total_sales") == [(1, D("7.50"))]


def test_missing_price_leaves_the_amounts_out(validate):
    found = validate(document(1, (5, 1), (1, 1)))
    assert plain(summary.daily_summary(found), "total_sales", "total_profit") == [(D("2.50"), D("1.50"))]


def test_stock_floor_unsold_products_and_unknown_stock(validate, products):
    found = validate(document(1, (1, 8)), document(2, (1, 8)), document(3, (99, 1)))
    levels = inventory.update_inventory(products, found)
    assert plain(levels, "product_id", "current_stock") == [(1, 0), (2, 5), (3, 100), (4, None), (5, 10)]
    line = inventory.inventory_report(levels).filter("product_id = 1").first()["report_line"]
    assert line == "• item 1                         (ID:   1):    0 units"


def test_running_balance_carries_over_or_reloads(validate, products):
    found = validate(
        document(1, (1, 4)),
        document(2, (1, 3), (2, 6), (3, 0)),
        document(3, (1, 5), moment="2024-03-02T08:00:00.000000"),
    )
    columns = ["order_id", "product_id", "ordered_so_far", "remaining_stock"]
    carried = inventory.running_inventory(products, found)
    assert plain(carried, *columns) == [(1, 1, 4, 6), (2, 1, 7, 3), (3, 1, 12, 0)]
    reloaded = inventory.running_inventory(products, found, reload_daily=True)
    assert plain(reloaded, *columns) == [(1, 1, 4, 6), (2, 1, 7, 3), (3, 1, 5, 5)]


def test_orders_keep_unknown_customers(spark, validate):
    found = orders.orders_of(validate(document(1, (1, 1), customer=1), document(2, (1, 1), customer=8)))
    customers = spark.createDataFrame(
        [(1, "Ada", "B", "a@b.example", "1 Main St, Town", "555")], schemas.CUSTOMERS
    )
    joined = orders.orders_with_customers(found, customers)
    assert plain(joined, "order_id", "first_name") == [(1, "Ada"), (2, None)]


def test_profile_preview_and_formatted_orders(validate, products):
    found = orders.orders_of(validate(document(2, (1, 1)), document(1, (1, 1))))
    assert plain(summary.table_profile({"a": products, "b": found})) == [("a", 5, 8), ("b", 2, 4)]
    assert [r["order_id"] for r in summary.preview(found, ["order_id"], 1).collect()] == [1]
    texts = [tuple(r) for r in orders.sorted_orders(found).select("order_id", "order_datetime").collect()]
    assert texts == [(1, "2024-03-01T09:30:00.000001"), (2, "2024-03-01T09:30:00.000001")]


def test_items_sorted_and_cleaned(validate):
    found = orders.items_of(validate(document(2, (3, 1), (1, 1)), document(1, (2, 6), (1, 2))))
    rows = orders.sorted_items(found).select("order_id", "product_id", "quantity").collect()
    assert [tuple(r) for r in rows] == [(1, 1, 2), (2, 1, 1), (2, 3, 1)]
