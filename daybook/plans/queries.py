"""The registered queries: each takes (spark, sf_dir) and reads the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas
from daybook.functions import dates
from daybook.operators import as_of, distinct, forecast, inventory, lines, orders, running_stock, seasonal, series, summary, trend
from daybook.plans import driver_tables as given
from daybook.plans.batch_run import run_batches
from daybook.session import materialise, shared_dir
from daybook.sinks.bucketed import write_bucketed
from daybook.sinks.tables import write_batches, write_csv
from daybook.sources import variants
from daybook.sources.documents import between_days, on_days, read_batches, read_documents
from daybook.sources.files import read_csv, row_id

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BUCKETS = 8
RANGES = [("00010101", "19971231"), ("19980101", "99991231")]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Doubles rounded, so that results do not depend on the order of summation."""
    return df.withColumns({name: F.round(name, places) for name in columns})


# Sources and sinks ---------------------------------------------------------------------------


@query
def src_csv_roundtrip(spark, sf_dir):
    products = given.products(spark, sf_dir)
    path = shared_dir(spark, "products-csv")
    write_csv(products, path)
    return read_csv(spark, path, products.schema)


@query
def src_csv_customers(spark, sf_dir):
    customers = given.customers(spark, sf_dir)
    path = shared_dir(spark, "customers-csv")
    write_csv(customers, path)
    return read_csv(spark, path, customers.schema)


@query
def src_json_documents(spark, sf_dir):
    path = shared_dir(spark, "documents")
    given.transactions(spark, sf_dir).write.json(path)
    exploded = lines.explode_items(read_documents(spark, path))
    return exploded.select(
        "batch_date", "order_id", "customer_id", "order_datetime", "product_id", "product_name", "quantity"
    )


@query
def src_flat_documents(spark, sf_dir):
    """Documents stored without a day give the orders of the day that their time names."""
    path = shared_dir(spark, "flat-documents")
    given.transactions(spark, sf_dir).drop("batch_date").write.json(path)
    documents = between_days(read_documents(spark, path), RANGES[0][0], RANGES[1][1])
    validated = lines.validate_lines(lines.explode_items(documents), given.products(spark, sf_dir))
    return orders.orders_of_headers(materialise(orders.order_headers(validated), "headers"))


@query
def src_variant_documents(spark, sf_dir):
    """Documents with drifting fields: every item, with what of it could not be read."""
    path = shared_dir(spark, "drifting-documents")
    given.drifting_documents(spark, sf_dir).write.text(path)
    items = variants.read_variant_documents(spark, path)
    columns = ["batch_date", "order_id", "customer_id", "order_datetime", "product_id", "quantity"]
    return items.select(*columns, variants.KEPT, F.array_join(variants.PROBLEMS, ";").alias("problems"))


@query
def src_dated_batches(spark, sf_dir):
    """Neighbouring ranges of days, read apart, add up to the whole table."""
    path = shared_dir(spark, "validated")
    validated = given.validated(spark, sf_dir)
    write_batches(validated, path)
    stored = read_batches(spark, path, validated.schema)
    ranges = [between_days(stored, *days) for days in RANGES]
    return lines.with_amounts(ranges[0].unionByName(ranges[1])).select(
        "batch_date", "order_id", "product_id", "quantity", "final_quantity", "line_total"
    )


@query
def src_days_of_table(spark, sf_dir):
    """The batches of days that another table chooses; the other days' folders are not read."""
    path, days_path = shared_dir(spark, "days"), shared_dir(spark, "calendar")
    given.month_ends(spark, sf_dir).write.parquet(days_path)
    write_batches(given.orders(spark, sf_dir), path)
    days = spark.read.schema("batch_date date, closes_month boolean").parquet(days_path)
    return on_days(read_batches(spark, path, schemas.ORDERS), days.filter("closes_month"))


@query
def sink_csv_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "summary-csv")
    write_csv(summary.daily_summary(given.validated(spark, sf_dir)), path, single_file=True)
    return read_csv(spark, path, schemas.DAILY_SUMMARY)


def _day_counts(batches: DataFrame, name: str) -> DataFrame:
    return batches.groupBy("batch_date").agg(F.count("*").alias(name))


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers, stored: their orders and the totals that choose them read one small table."""
    return materialise(orders.order_headers(given.validated(spark, sf_dir)), "headers")


def _items(spark: SparkSession, sf_dir: str, row_ids: bool = False) -> DataFrame:
    """Line items of the trading days; what they need of the lines is stored, since days and items read it."""
    validated = given.validated(spark, sf_dir, row_ids)
    needed = [*orders.ORDER_KEY, "product_id", "final_quantity", "unit_price", "line_cents", *lines.tie_break(validated)]
    return orders.items_of(materialise(validated.select(*needed), "lines"))


@query
def sink_partitioned_batches(spark, sf_dir):
    """Writes every day, then the days of one range once more; no day may count double."""
    path = shared_dir(spark, "items")
    items = materialise(_items(spark, sf_dir), "items")
    write_batches(items, path)
    write_batches(between_days(items, *RANGES[1]), path)
    return _day_counts(read_batches(spark, path, schemas.ORDER_LINE_ITEMS), "n_items")


@query
def union_batches(spark, sf_dir):
    """Two runs over neighbouring ranges of days add up to one table of orders."""
    path = shared_dir(spark, "orders")
    found = materialise(orders.orders_of_headers(_headers(spark, sf_dir)), "orders")
    for days in RANGES:
        write_batches(between_days(found, *days), path)
    return read_batches(spark, path, schemas.ORDERS)


@query
def batch_run(spark, sf_dir):
    """The whole job, from nested documents to the line items it stored."""
    documents, products = given.transactions(spark, sf_dir), given.products(spark, sf_dir)
    days = RANGES[0][0], RANGES[1][1]
    return run_batches(documents, products, shared_dir(spark, "run"), *days)["order_line_items"]


@query
def batch_run_written(spark, sf_dir):
    """What a run counted while it wrote."""
    documents, products = given.transactions(spark, sf_dir), given.products(spark, sf_dir)
    found = run_batches(documents, products, shared_dir(spark, "run"), RANGES[0][0], RANGES[1][1])
    return found.written.filter(F.col("table_name").isin("orders", "order_line_items", "daily_summary", "products_updated"))


@query
def batch_run_dated_catalogue(spark, sf_dir):
    """Line items of a run whose catalogue changes from day to day."""
    documents, versions = given.transactions(spark, sf_dir), given.product_versions(spark, sf_dir)
    found = run_batches(documents, versions, shared_dir(spark, "run"), RANGES[0][0], RANGES[1][1])
    return found["order_line_items"]


def _two_runs(spark: SparkSession, sf_dir: str, result: str) -> DataFrame:
    """One result of the job after a run over each range of days."""
    documents, products = given.transactions(spark, sf_dir), given.products(spark, sf_dir)
    out = shared_dir(spark, "runs")
    for days in RANGES:
        found = run_batches(documents, products, out, *days)
    return found[result]


@query
def batch_run_orders(spark, sf_dir):
    return _two_runs(spark, sf_dir, "orders")


@query
def batch_run_summary(spark, sf_dir):
    return _two_runs(spark, sf_dir, "daily_summary")


@query
def batch_run_stock(spark, sf_dir):
    return _two_runs(spark, sf_dir, "products_updated")


def _calendar(df: DataFrame) -> DataFrame:
    bounds = df.agg(F.min("batch_date").alias("first_day"), F.max("batch_date").alias("last_day"))
    return dates.date_spine(bounds, "first_day", "last_day")


@query
def date_spine(spark, sf_dir):
    return _calendar(given.orders(spark, sf_dir))


@query
def empty_batch_schema(spark, sf_dir):
    """Orders and items of every calendar day, none where no order is valid, and their columns."""
    headers = _headers(spark, sf_dir)
    found = orders.orders_of_headers(headers)
    n_items = headers.groupBy("batch_date").agg(F.sum("lines").alias("n_items"))
    counts = (
        _calendar(given.orders(spark, sf_dir))
        .withColumnRenamed("date", "batch_date")
        .join(_day_counts(found, "n_orders"), "batch_date", "left")
        .join(n_items, "batch_date", "left")
        .na.fill(0, ["n_orders", "n_items"])
        .withColumn("n_items", F.when(F.col("n_orders") > 0, F.col("n_items")).otherwise(0))
    )
    return counts.select(
        "batch_date",
        "n_orders",
        "n_items",
        F.lit(",".join(found.columns)).alias("order_columns"),
        F.lit(",".join(schemas.ORDER_LINE_ITEMS.fieldNames())).alias("item_columns"),
    )


@query
def table_profile(spark, sf_dir):
    return summary.table_profile(
        {
            "customers": given.customers(spark, sf_dir),
            "products": given.products(spark, sf_dir),
            "orders": given.orders(spark, sf_dir),
            "lines": given.lines(spark, sf_dir),
        }
    )


@query
def preview_topn(spark, sf_dir):
    return summary.preview(given.orders(spark, sf_dir), ["order_id", "order_datetime"], 10)


# Projections, filters, joins -----------------------------------------------------------------


@query
def project_rename_cast(spark, sf_dir):
    return given.order_items(spark, sf_dir).select(
        F.col("order_id").alias("transaction_id"),
        F.col("product_id").cast("int").alias("item_code"),
        F.col("quantity").try_cast("int").alias("qty"),
        F.col("quantity").cast(schemas.MONEY).alias("qty_amount"),
    )


@query
def explode_order_items(spark, sf_dir):
    exploded = lines.explode_items(given.transactions(spark, sf_dir))
    return exploded.select(
        "batch_date", "order_id", "customer_id", "order_datetime", "product_id", "product_name", "quantity"
    )


LINE = ["batch_date", "order_id", "customer_id", "product_id", "quantity"]


@query
def filter_null_quantity(spark, sf_dir):
    return lines.requested(given.lines(spark, sf_dir)).select(*LINE)


@query
def filter_positive_quantity(spark, sf_dir):
    quantity = F.col("quantity")
    return given.lines(spark, sf_dir).filter(quantity.isNotNull() & (quantity > 0)).select(*LINE)


@query
def join_orders_items(spark, sf_dir):
    headers = given.orders(spark, sf_dir)
    items = given.order_items(spark, sf_dir)
    return orders.orders_with_items(headers, items).select(*LINE, "order_datetime")


@query
def join_bucketed_orders(spark, sf_dir):
    """Orders with the sums of their items, from two tables stored in buckets by order id."""
    headers = given.orders(spark, sf_dir).select("order_id", "customer_id")
    items = given.order_items(spark, sf_dir)
    stored = [write_bucketed(df, shared_dir(spark, "bucketed"), "order_id", BUCKETS) for df in (headers, items)]
    return orders.totals_with_items(*stored)


@query
def join_items_products_left(spark, sf_dir):
    joined = lines.with_catalogue(given.order_items(spark, sf_dir), given.products(spark, sf_dir))
    return joined.select("order_id", "product_id", "quantity", "unit_price", "cost_to_make", "stock")


@query
def semi_valid_orders(spark, sf_dir):
    validated = materialise(given.validated(spark, sf_dir).select(*LINE, "final_quantity"), "lines")
    return orders.lines_of_valid_orders(validated)


@query
def enrich_orders_customers(spark, sf_dir):
    return orders.orders_with_customers(given.orders(spark, sf_dir), given.customers(spark, sf_dir))


# Validation, pricing, orders -----------------------------------------------------------------


@query
def validate_stock(spark, sf_dir):
    return given.validated(spark, sf_dir).select(*LINE, "stock", "final_quantity")


def _running_stock(spark: SparkSession, sf_dir: str, reload_daily: bool) -> DataFrame:
    asked, products = given.lines(spark, sf_dir, row_ids=True), given.products(spark, sf_dir)
    checked = running_stock.validate_running_stock(asked, products, "opening_stock", reload_daily)
    return lines.with_amounts(checked).select(*LINE, "final_quantity", "line_total", "profit")


@query
def validate_running_stock(spark, sf_dir):
    """Lines filled only by what earlier filled lines have left."""
    return _running_stock(spark, sf_dir, reload_daily=False)


@query
def validate_running_stock_daily_reload(spark, sf_dir):
    return _running_stock(spark, sf_dir, reload_daily=True)


@query
def price_as_of(spark, sf_dir):
    """Each line with the price, cost and stock that its product had on the day."""
    asked, versions = given.lines(spark, sf_dir, row_ids=True), given.product_versions(spark, sf_dir)
    found = as_of.validate_lines_as_of(asked, versions)
    return lines.with_amounts(found).select(*LINE, "unit_price", "stock", "final_quantity", "line_total", "profit")


@query
def line_total(spark, sf_dir):
    return lines.with_amounts(given.validated(spark, sf_dir)).select(
        "order_id", "product_id", "final_quantity", "unit_price", "line_total"
    )


@query
def profit_per_line(spark, sf_dir):
    return lines.with_amounts(given.validated(spark, sf_dir)).select(
        "order_id", "product_id", "final_quantity", "profit"
    )


@query
def valid_orders_having(spark, sf_dir):
    return orders.valid_orders(given.validated(spark, sf_dir))


@query
def cancelled_orders(spark, sf_dir):
    return orders.cancelled_orders(given.validated(spark, sf_dir, all_lines=True))


@query
def cancelled_item_count(spark, sf_dir):
    return lines.cancelled_item_count(given.validated(spark, sf_dir))


@query
def orders_distinct(spark, sf_dir):
    return orders.orders_of_headers(_headers(spark, sf_dir))


@query
def order_line_items(spark, sf_dir):
    return _items(spark, sf_dir)


@query
def orders_formatted(spark, sf_dir):
    headers = given.orders(spark, sf_dir, row_id()).drop("batch_date")
    return orders.sorted_orders(headers).drop(schemas.ROW_ID)


@query
def order_line_items_clean(spark, sf_dir):
    items = _items(spark, sf_dir, row_ids=True)
    return orders.sorted_items(items).drop(schemas.ROW_ID)


# Roll-ups and stock --------------------------------------------------------------------------


@query
def count_distinct_orders(spark, sf_dir):
    return summary.distinct_orders_per_day(given.validated(spark, sf_dir))


@query
def distinct_orders_of_range(spark, sf_dir):
    """Distinct orders of overlapping ranges of days, from one bitmap table and no lines."""
    bitmaps = materialise(distinct.order_bitmaps(given.validated(spark, sf_dir)), "bitmaps")
    found = distinct.distinct_in_ranges(bitmaps, given.overlapping_ranges(spark, sf_dir))
    return found.withColumnRenamed("num_keys", "num_orders")


@query
def daily_summary(spark, sf_dir):
    return summary.daily_summary(given.validated(spark, sf_dir))


@query
def ordered_qty_per_product(spark, sf_dir):
    return inventory.ordered_per_product(given.validated(spark, sf_dir))


def _stock_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, validated = given.products(spark, sf_dir), given.validated(spark, sf_dir)
    return inventory.update_inventory(products, validated, stock="opening_stock")


@query
def update_inventory(spark, sf_dir):
    return _stock_levels(spark, sf_dir)


@query
def inventory_report(spark, sf_dir):
    return inventory.inventory_report(_stock_levels(spark, sf_dir))


def _running(spark: SparkSession, sf_dir: str, reload_daily: bool) -> DataFrame:
    products, validated = given.products(spark, sf_dir), given.validated(spark, sf_dir, row_ids=True)
    return inventory.running_inventory(products, validated, "opening_stock", reload_daily)


@query
def running_inventory(spark, sf_dir):
    return _running(spark, sf_dir, reload_daily=False)


@query
def running_inventory_daily_reload(spark, sf_dir):
    return _running(spark, sf_dir, reload_daily=True)


# Series and forecasts ------------------------------------------------------------------------


def _summary_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.summary_series(summary.daily_summary(given.validated(spark, sf_dir)))


def _event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.event_series(given.table(spark, sf_dir, "events"), "event_type", "ts", "value")


@query
def series_prepare(spark, sf_dir):
    return series.prepare_series(_summary_series(spark, sf_dir))


@query
def series_info(spark, sf_dir):
    return rounded(series.series_info(_summary_series(spark, sf_dir)), 4, "mean_y")


@query
def forecast_dates(spark, sf_dir):
    fits = forecast.fit_linear(_event_series(spark, sf_dir))
    return series.future_dates(fits, forecast.WEEK_HORIZON).select("series_key", "date")


def _sales_forecast(spark: SparkSession, sf_dir: str, horizon: int) -> DataFrame:
    fits = forecast.fit_linear(_summary_series(spark, sf_dir))
    wide = forecast.sales_and_profit(forecast.predict_linear(fits, horizon))
    return rounded(wide, 4, "forecasted_sales", "forecasted_profit")


@query
def forecast_linear(spark, sf_dir):
    return _sales_forecast(spark, sf_dir, forecast.DEFAULT_HORIZON)


@query
def forecast_horizon7(spark, sf_dir):
    return _sales_forecast(spark, sf_dir, forecast.WEEK_HORIZON)


@query
def forecast_multi_series(spark, sf_dir):
    fits = forecast.fit_linear(_event_series(spark, sf_dir))
    return rounded(forecast.predict_linear(fits, forecast.WEEK_HORIZON), 4, "yhat")


@query
def forecast_metrics(spark, sf_dir):
    observed = _summary_series(spark, sf_dir)
    fitted = forecast.fitted_linear(observed, forecast.fit_linear(observed))
    return rounded(forecast.forecast_metrics(fitted), 2, "mae", "mse")


@query
def forecast_rolling_errors(spark, sf_dir):
    """Errors on days that the lines had not seen, for every origin and up to a week ahead."""
    found = forecast.rolling_errors(_summary_series(spark, sf_dir), forecast.WEEK_HORIZON)
    return rounded(found, 2, "mae", "mse")


@query
def series_segments(spark, sf_dir):
    """The sums per series and segment between knots from which trends are fitted."""
    sums = trend.segment_sums(trend.scaled_days(_summary_series(spark, sf_dir)))
    return rounded(sums.select("series_key", "segment", *trend.MOMENTS), 6, *trend.MOMENTS)


@query
def forecast_piecewise(spark, sf_dir):
    fits = trend.fit_trend(_summary_series(spark, sf_dir))
    wide = forecast.sales_and_profit(trend.predict_trend(fits, forecast.WEEK_HORIZON))
    return rounded(wide, 4, "forecasted_sales", "forecasted_profit")


@query
def forecast_piecewise_multi(spark, sf_dir):
    fits = trend.fit_trend(_event_series(spark, sf_dir))
    return rounded(trend.predict_trend(fits, forecast.WEEK_HORIZON), 4, "yhat")


@query
def forecast_seasonal(spark, sf_dir):
    fits = seasonal.fit_seasonal(_summary_series(spark, sf_dir))
    wide = forecast.sales_and_profit(seasonal.predict_seasonal(fits, forecast.DEFAULT_HORIZON))
    return rounded(wide, 4, "forecasted_sales", "forecasted_profit")


@query
def forecast_seasonal_multi(spark, sf_dir):
    fits = seasonal.fit_seasonal(_event_series(spark, sf_dir))
    return rounded(seasonal.predict_seasonal(fits, forecast.WEEK_HORIZON), 4, "yhat")


@query
def forecast_seasonal_metrics(spark, sf_dir):
    observed = _event_series(spark, sf_dir)
    fitted = seasonal.fitted_seasonal(observed, seasonal.fit_seasonal(observed))
    return rounded(forecast.forecast_metrics(fitted), 4, "mae", "mse")
