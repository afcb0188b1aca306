"""The whole batch job over a range of days: one plan for all days, each result written once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import schemas
from daybook.functions.money import floor_at_zero, from_cents
from daybook.operators import as_of, forecast, orders, seasonal
from daybook.operators.lines import explode_items, validate_lines
from daybook.operators.series import summary_series
from daybook.session import scratch_tables, tune
from daybook.sinks.editions import Edition
from daybook.sinks.tables import MONTH
from daybook.sources.documents import between_days, day_bounds


class Results(dict[str, DataFrame]):
    """The results by name; ``written`` has rows, days or months, and cancelled lines of what a run wrote."""

    written: DataFrame


def summary_by_day(headers: DataFrame) -> DataFrame:
    """Orders, sales and profit in cents per day of a batch and date of the order, and the lines that
    were cancelled that day."""
    totals = orders.header_totals(headers)
    sold = orders.valid(totals).groupBy("batch_date", "date").agg(
        F.count("*").alias("num_orders"), F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
    )
    lost = headers.groupBy("batch_date").agg(F.sum("cancelled").alias("cancelled"))
    dateless = lost.select(
        "batch_date", F.lit(None).cast("date").alias("date"), F.lit(0).cast("bigint").alias("num_orders"),
        *(F.lit(None).cast("bigint").alias(name) for name in ("sales", "profit")), "cancelled",
    )
    return sold.withColumn("cancelled", F.lit(0).cast("bigint")).unionByName(dateless)


def _summary(stored: DataFrame) -> DataFrame:
    return (
        stored.filter("num_orders > 0")
        .groupBy("date")
        .agg(
            F.sum("num_orders").alias("num_orders"),
            from_cents(F.sum("sales")).alias("total_sales"),
            from_cents(F.sum("profit")).alias("total_profit"),
        )
        .orderBy("date")
    )


def _stock(products: DataFrame, stored: DataFrame, reload_daily: bool) -> DataFrame:
    """Stock after all stored days; with ``reload_daily`` after the last one, from the full stock."""
    if reload_daily:
        last = stored.agg(F.max("batch_date").alias("batch_date"))
        stored = stored.join(F.broadcast(last), "batch_date", "left_semi")
    units = stored.groupBy("product_id").agg(F.sum("units").alias("units"))
    left = floor_at_zero(F.col("stock") - F.coalesce("units", F.lit(0))).cast("bigint")
    joined = products.join(units, "product_id", "left")
    return joined.select("product_id", "product_name", left.alias("current_stock")).orderBy("product_id")


def run_batches(
    documents: DataFrame,
    products: DataFrame,
    out: str,
    first: str,
    last: str,
    forecast_days: int = forecast.DEFAULT_HORIZON,
    fmt: str = "parquet",
    reload_daily: bool = False,
    shuffled_bytes: int | None = None,
) -> Results:
    """Process the documents of an inclusive range of days and write every result under ``out``.

    Catalogue, validated lines and order headers are each computed once, into the shared folder, and
    removed when the results are written; all results see the same stock, and Spark knows the sizes
    also where the catalogue comes from a database. Orders and items are stored by day, and by month
    the summary of every day and the units of each product on it. A run replaces all days of its range,
    also those that have become empty. Summary, stock, forecast and its errors are derived from all stored
    days, so running day by day ends with the same results as one run over all days.

    Nothing of a run is seen before all of it is written: results are read through the manifest that the
    run publishes last, see :mod:`daybook.sinks.editions`. A catalogue with ``valid_from`` gives each line
    price, cost and stock of its day, and the stock left by the versions of the last stored day.

    ``reload_daily`` fills the stock up every day. ``shuffled_bytes``, the most a step shuffles,
    sizes the shuffles. A range without any documents gives empty results. The results are the
    tables by day, daily_summary, products_updated, forecast, forecast_metrics (mean absolute and
    squared error of the fit per target) and cancelled_items, the cancelled lines of each day; their
    ``written`` counts what the run wrote.
    """
    spark = documents.sparkSession
    if shuffled_bytes is not None:
        tune(spark, shuffled_bytes)
    bounds = day_bounds(first, last)
    dated = as_of.VALID_FROM in products.columns
    edition = Edition(spark, out)

    with scratch_tables(spark) as scratch:
        products = scratch.store(products, "catalogue")
        fresh = explode_items(between_days(documents, first, last))
        validate = as_of.validate_lines_as_of if dated else validate_lines
        lines = scratch.store(validate(fresh, products), "lines")
        headers = scratch.store(orders.order_headers(lines), "headers")
        days = orders.trading_days(orders.valid(orders.header_totals(headers)))
        units = lines.groupBy("batch_date", "product_id").agg(F.sum("final_quantity").alias("units"))
        items = orders.items_of(lines, days).drop(schemas.ROW_ID)

        edition.write_days("orders", orders.orders_of_headers(headers), *bounds, fmt, ["order_id"])
        edition.write_days("order_line_items", items, *bounds, fmt, ["order_id", "product_id"])
        edition.write_days_in_months("summary_by_day", summary_by_day(headers), *bounds, scratch)
        edition.write_days_in_months("units_by_day", units, *bounds, scratch)

        by_day = edition.read("summary_by_day", schemas.SUMMARY_BY_DAY, MONTH)
        sold = edition.read("units_by_day", schemas.UNITS_BY_DAY, MONTH)
        if dated:
            products = as_of.latest(products, F.lit(sold.agg(F.max("batch_date")).first()[0] or bounds[1]))
        edition.write_whole("daily_summary", _summary(by_day), single_file=True)
        edition.write_whole("products_updated", _stock(products, sold, reload_daily))

        series = summary_series(edition.read("daily_summary", schemas.DAILY_SUMMARY, fmt="csv"))
        fits = seasonal.fit_seasonal(series)
        predicted = forecast.sales_and_profit(seasonal.predict_seasonal(fits, forecast_days))
        edition.write_whole("forecast", predicted, single_file=True)
        errors = forecast.forecast_metrics(seasonal.fitted_seasonal(series, fits))
        edition.write_whole("forecast_metrics", errors, single_file=True)
    edition.publish()

    results = Results(
        orders=edition.read("orders", schemas.ORDERS, "batch_date", fmt),
        order_line_items=edition.read("order_line_items", schemas.ORDER_LINE_ITEMS, "batch_date", fmt),
        daily_summary=edition.read("daily_summary", schemas.DAILY_SUMMARY, fmt="csv"),
        products_updated=edition.read("products_updated", schemas.STOCK_LEVELS, fmt="csv"),
        forecast=edition.read("forecast", schemas.FORECAST, fmt="csv"),
        forecast_metrics=edition.read("forecast_metrics", schemas.FORECAST_METRICS, fmt="csv"),
        cancelled_items=by_day.groupBy("batch_date").agg(F.sum("cancelled").alias("cancelled_items")),
    )
    results.written = edition.written()
    return results
