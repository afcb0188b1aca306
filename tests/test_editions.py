"""Runs that stop half-way, runs that race, and what is read meanwhile."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook import schemas
from daybook.operators.lines import explode_items, validate_lines
from daybook.plans.batch_run import run_batches
from daybook.sinks import editions
from daybook.sinks.editions import Edition
from daybook.sinks.tables import MONTH
from tests.conftest import day, document, plain

TABLES = {
    "orders": (schemas.ORDERS, "batch_date", "parquet"),
    "order_line_items": (schemas.ORDER_LINE_ITEMS, "batch_date", "parquet"),
    "summary_by_day": (schemas.SUMMARY_BY_DAY, MONTH, "parquet"),
    "units_by_day": (schemas.UNITS_BY_DAY, MONTH, "parquet"),
    "daily_summary": (schemas.DAILY_SUMMARY, None, "csv"),
    "products_updated": (schemas.STOCK_LEVELS, None, "csv"),
    "forecast": (schemas.FORECAST, None, "csv"),
    "forecast_metrics": (schemas.FORECAST_METRICS, None, "csv"),
}
RANGE = "20240301", "20240304"


def _documents(spark, items):
    nested = [document(n, *items, moment=f"2024-03-0{1 + n % 4}T10:00:00.000000") for n in range(9)]
    return spark.createDataFrame(nested, schemas.TRANSACTIONS).withColumn("batch_date", F.to_date("timestamp"))


def _all(spark, out):
    return {n: plain(editions.read_table(spark, out, n, *how)) for n, how in TABLES.items()}


class Stopped(Exception):
    pass


def test_a_run_that_stops_after_any_write_leaves_the_edition_before(spark, products, tmp_path, monkeypatch):
    out = str(tmp_path)
    run_batches(_documents(spark, [(1, 2), (2, 99)]), products, out, *RANGE)
    before, writes = _all(spark, out), {"n": 0}
    assert all(before.values())

    def stopping(method):
        original = getattr(Edition, method)

        def write(self, *arguments, **named):
            found = original(self, *arguments, **named)
            writes["n"] += 1
            if writes["n"] == writes["stop"]:
                raise Stopped
            return found

        return write

    for method in ("write_days", "write_days_in_months", "write_whole"):
        monkeypatch.setattr(Edition, method, stopping(method))
    other = _documents(spark, [(3, 4)])
    for stop in range(1, 9):
        writes.update(n=0, stop=stop)
        with pytest.raises(Stopped):
            run_batches(other, products, out, *RANGE)
        assert _all(spark, out) == before, stop
    writes.update(n=0, stop=None)
    found = run_batches(other, products, out, *RANGE)
    after = _all(spark, out)
    assert writes["n"] == 8 and after["orders"] == plain(found["orders"])
    assert {r[2] for r in after["order_line_items"]} == {3} and after["products_updated"] != before["products_updated"]
    assert plain(editions.read_table(spark, out, "orders", *TABLES["orders"], number=1)) == before["orders"]


def test_written_counts_equal_the_tables_without_another_job(spark, products, tmp_path):
    documents = _documents(spark, [(1, 2), (2, 99), (9, 1)])
    found = run_batches(documents, products, str(tmp_path), *RANGE)
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counts", "counts")
    written = found.written
    assert not status.getJobIdsForGroup("counts")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    counts = {r["table_name"]: tuple(r)[1:] for r in written.collect()}
    lines = validate_lines(explode_items(documents), products)
    cancelled = lines.filter("final_quantity IS NULL").count()
    assert counts["orders"] == (9, 4, 0)
    assert counts["order_line_items"] == (found["order_line_items"].count(), 4, cancelled) and cancelled == 18
    assert counts["summary_by_day"][1:] == (1, cancelled)
    assert counts["daily_summary"][0] == found["daily_summary"].count() == 4


def test_a_second_run_that_began_before_the_first_was_published(spark, tmp_path):
    rows = spark.createDataFrame([(day("2024-03-01"), 1, 2)], schemas.UNITS_BY_DAY)
    first, second = (Edition(spark, str(tmp_path)) for _ in range(2))
    for edition in (first, second):
        edition.write_days("units", rows, dt.date(2024, 3, 1), dt.date(2024, 3, 1))
    first.publish()
    with pytest.raises(RuntimeError):
        second.publish()
    assert editions.published(spark, str(tmp_path)) == [1]
    assert plain(editions.read_table(spark, str(tmp_path), "units", schemas.UNITS_BY_DAY, "batch_date")) == plain(rows)


def test_prune_keeps_what_the_last_editions_hold(spark, products, tmp_path):
    out = str(tmp_path)
    for code in ("20240301", "20240302", "20240303", "20240304", "20240302"):
        found = run_batches(_documents(spark, [(1, 2)]), products, out, code, code)
    want = _all(spark, out)
    editions.prune(spark, out, keep=1)
    assert _all(spark, out) == want and plain(found["orders"]) == want["orders"]
    assert editions.published(spark, out) == [5]
    assert len(list((tmp_path / "daily_summary").iterdir())) == 1
    assert len(list((tmp_path / "orders").iterdir())) == 4  # the second day's first run is gone


def test_run_with_a_catalogue_of_versions(spark, products, tmp_path):
    versions = products.withColumn("valid_from", F.lit("2024-01-01").cast("date")).unionByName(
        products.filter("product_id = 1").withColumns(
            {"valid_from": F.lit("2024-03-03").cast("date"), "stock": F.lit(1), "sales_price": F.col("sales_price") * 2})
    )
    found = run_batches(_documents(spark, [(1, 2), (3, 1)]), versions, str(tmp_path), *RANGE)
    of_one = found["order_line_items"].filter("product_id = 1")
    assert {(r[0].day, r[3] is None) for r in plain(of_one)} == {(1, False), (2, False), (3, True), (4, True)}
    assert dict(plain(found["products_updated"], "product_id", "current_stock"))[1] == 0
    assert dict(plain(found["products_updated"], "product_id", "current_stock"))[3] == 91


def test_nothing_published_reads_as_empty(spark, tmp_path):
    assert editions.published(spark, str(tmp_path)) == []
    assert editions.read_table(spark, str(tmp_path), "orders", schemas.ORDERS, "batch_date").count() == 0
