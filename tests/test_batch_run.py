import pytest
from pyspark.sql import functions as F

from daybook import schemas, session
from daybook.operators import inventory, orders, summary
from daybook.operators.lines import explode_items, validate_lines
from daybook.plans.batch_run import run_batches
from tests.conftest import day, document, plain


def _documents(spark):
    nested = [
        document(order, (1 + order % 3, order % 5), (3, 2), moment=f"2024-03-0{d}T10:00:00.000000")
        for d in range(1, 6)
        for order in range(10 * d, 10 * d + 2 * d)
    ]
    nested.append(document(99, (2, 6), moment="2024-03-06T10:00:00.000000"))
    frame = spark.createDataFrame(nested, schemas.TRANSACTIONS)
    return frame.withColumn("batch_date", F.to_date("timestamp"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_run_equals_the_operators(spark, products, tmp_path, fmt):
    documents = _documents(spark)
    whole = run_batches(documents, products, str(tmp_path), "20240301", "20240306", fmt=fmt)
    lines = validate_lines(explode_items(documents), products)
    assert plain(whole["orders"]) == plain(orders.orders_of(lines).select(whole["orders"].columns))
    items = whole["order_line_items"]
    assert plain(items) == plain(orders.items_of(lines).select(items.columns))
    assert plain(whole["daily_summary"]) == plain(summary.daily_summary(lines))
    assert plain(whole["products_updated"]) == plain(inventory.update_inventory(products, lines))
    predicted = whole["forecast"].collect()
    assert [row["date"] for row in predicted] == [day("2024-03-06")]
    assert all(row["forecasted_sales"] > 0 for row in predicted)


def test_days_can_be_run_one_by_one(spark, products, tmp_path):
    documents = _documents(spark)
    whole = run_batches(documents, products, str(tmp_path / "whole"), "20240301", "20240306")
    for d in range(1, 7):
        code = f"2024030{d}"
        daily = run_batches(documents, products, str(tmp_path / "daily"), code, code)
    for name, result in whole.items():
        assert plain(daily[name]) == plain(result), name
    assert daily["daily_summary"].count() == 5 and daily["forecast"].first()[1] is not None


def test_range_without_documents_gives_empty_typed_results(spark, products, tmp_path):
    found = run_batches(_documents(spark), products, str(tmp_path / "none"), "20230101", "20230105")
    assert {name: df.count() for name, df in found.items()} == {
        "orders": 0, "order_line_items": 0, "daily_summary": 0,
        "products_updated": 5, "forecast": 0, "forecast_metrics": 0, "cancelled_items": 0,
    }
    assert dict(found["daily_summary"].dtypes)["total_sales"] == "decimal(18,2)"


def test_a_day_that_lost_its_orders_is_not_read_back(spark, products, tmp_path):
    documents, out = _documents(spark), str(tmp_path)
    run_batches(documents, products, out, "20240301", "20240305")
    fewer = documents.filter("batch_date <> date'2024-03-02'")
    found = run_batches(fewer, products, out, "20240301", "20240305")
    assert day("2024-03-02") not in {row[0] for row in plain(found["orders"], "batch_date")}
    assert day("2024-03-02") not in {row[0] for row in plain(found["daily_summary"], "date")}
    for name in ("orders", "order_line_items"):
        assert not (tmp_path / name / "batch_date=2024-03-02").exists()
    again = run_batches(documents.filter("batch_date > date'2024-03-05'"), products, out, "20240301", "20240305")
    assert {name: again[name].count() for name in ("orders", "order_line_items", "daily_summary", "forecast")} == {
        "orders": 0, "order_line_items": 0, "daily_summary": 0, "forecast": 0,
    }
    assert plain(again["products_updated"], "current_stock") == plain(products, "stock")


def test_months_keep_the_days_outside_the_range(spark, products, tmp_path):
    nested = [
        document(n, (1, 1), moment=f"2024-{month:02d}-{d:02d}T10:00:00.000000")
        for n, (month, d) in enumerate([(1, 30), (1, 31), (2, 1), (2, 15), (2, 16), (3, 1)])
    ]
    documents = spark.createDataFrame(nested, schemas.TRANSACTIONS)
    out = str(tmp_path)
    run_batches(documents, products, out, "20240101", "20240331")
    fewer = documents.filter("transaction_id not in (1, 2, 3)")
    found = run_batches(fewer, products, out, "20240131", "20240215")
    assert plain(found["daily_summary"], "date") == [
        (day(d),) for d in ("2024-01-30", "2024-02-16", "2024-03-01")
    ]
    assert dict(plain(found["products_updated"], "product_id", "current_stock"))[1] == 7


def test_an_unreadable_time_counts_on_the_day_of_the_batch(spark, products, tmp_path):
    documents = _documents(spark)
    bad = spark.createDataFrame([document(500, (3, 4), moment="soon")], schemas.TRANSACTIONS).withColumn(
        "batch_date", F.lit("2024-03-03").cast("date")
    )
    found = run_batches(documents.unionByName(bad), products, str(tmp_path), "20240301", "20240306")
    plainly = run_batches(documents, products, str(tmp_path / "plain"), "20240301", "20240306")
    by_date = dict(plain(found["daily_summary"], "date", "num_orders"))
    before = dict(plain(plainly["daily_summary"], "date", "num_orders"))
    assert by_date == before | {day("2024-03-03"): before[day("2024-03-03")] + 1}


def test_errors_cancelled_lines_and_daily_reload(spark, products, tmp_path):
    documents = _documents(spark)
    found = run_batches(documents, products, str(tmp_path), "20240301", "20240306", reload_daily=True)
    assert dict(plain(found["cancelled_items"]))[day("2024-03-06")] == 1
    errors = {row["series_key"]: row for row in found["forecast_metrics"].collect()}
    assert set(errors) == {"total_sales", "total_profit"}
    assert all(row["mae"] >= 0 and row["mse"] >= row["mae"] ** 2 - 1e-9 for row in errors.values())
    last = validate_lines(explode_items(documents.filter("batch_date = date'2024-03-06'")), products)
    assert plain(found["products_updated"]) == plain(inventory.update_inventory(products, last))


def test_scratch_tables_are_removed(spark, products, tmp_path, monkeypatch):
    names = []
    monkeypatch.setattr(session, "shared_dir", lambda _, purpose: names.append(purpose) or f"{tmp_path}/scratch/{purpose}{len(names)}")
    run_batches(_documents(spark), products, str(tmp_path / "out"), "20240301", "20240306")
    assert {"catalogue", "lines", "headers", "months"} <= set(names)
    assert list((tmp_path / "scratch").iterdir()) == []
