"""Straight-line forecasts for any number of series at once, and their errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.series import future_dates, observed, with_fits

DEFAULT_HORIZON = 1
WEEK_HORIZON = 7


def _day(date: Column) -> Column:
    return F.unix_date(date).cast("double")


def fit_linear(series: DataFrame) -> DataFrame:
    """Least-squares line per series from one aggregation; null slope for fewer than two days.

    Days without a date or a value do not count, in none of the sums.
    """
    x, y = _day(F.col("date")), F.col("y")
    return observed(series).groupBy("series_key").agg(
        F.regr_slope(y, x).alias("slope"),
        F.avg(x).alias("mean_day"),
        F.avg(y).alias("mean_y"),
        F.max("date").alias("last_date"),
    )


def _line() -> Column:
    return F.col("mean_y") + F.col("slope") * (_day(F.col("date")) - F.col("mean_day"))


def predict_linear(fits: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
    """(series_key, date, yhat) for the days after each series."""
    return future_dates(fits, horizon).select("series_key", "date", _line().alias("yhat"))


def fitted_linear(series: DataFrame, fits: DataFrame) -> DataFrame:
    """(series_key, date, y, yhat) on the days of the series."""
    return with_fits(series, fits).select("series_key", "date", "y", _line().alias("yhat"))


def forecast_metrics(fitted: DataFrame) -> DataFrame:
    """Mean absolute and mean squared error per series, unrounded."""
    error = F.col("y") - F.col("yhat")
    return fitted.groupBy("series_key").agg(
        F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse")
    )


def rolling_lines(series: DataFrame) -> DataFrame:
    """The line through all days up to each day, as (series_key, date, points, slope, mean_day, mean_y).

    The sums behind a line grow by one day at a time, so one pass gives the lines of all days; a series
    has a row a day, which the calendar bounds. Days count from the first of the series, which keeps
    the sums small. The slope is null for fewer than two days.
    """
    known = observed(series)
    start = F.min("date").over(Window.partitionBy("series_key"))
    past = Window.partitionBy("series_key").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x, y = F.col("x"), F.col("y")
    sums = known.withColumn("x", F.date_diff("date", start).cast("double")).select(
        "series_key", "date", "x",
        F.count("*").over(past).alias("points"), F.sum(x).over(past).alias("sx"), F.sum(y).over(past).alias("sy"),
        F.sum(x * x).over(past).alias("sxx"), F.sum(x * y).over(past).alias("sxy"),
    )
    n, sx, sy = F.col("points"), F.col("sx"), F.col("sy")
    spread = n * F.col("sxx") - sx * sx
    slope = F.when(spread > 0, (n * F.col("sxy") - sx * sy) / spread)
    return sums.select("series_key", "date", "x", "points", slope.alias("slope"), (sx / n).alias("mean_day"), (sy / n).alias("mean_y"))


def rolling_errors(series: DataFrame, horizon: int = DEFAULT_HORIZON, least_points: int = 3) -> DataFrame:
    """How far lines were off on days they had not seen: series_key, ahead, origins, mae, mse.

    Every day with at least ``least_points`` days up to it is an origin; its line forecasts the
    ``horizon`` days after it, and those of them that the series has are compared. So each forecast uses
    only what was known on its day, unlike :func:`forecast_metrics` of a fit over all days.
    """
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("ahead")
    lines = rolling_lines(series).filter(F.col("slope").isNotNull() & (F.col("points") >= least_points))
    forecasts = lines.select(
        "series_key", "date", "x", "slope", "mean_day", "mean_y", ahead
    ).select(
        "series_key", "ahead", F.date_add("date", F.col("ahead")).alias("date"),
        (F.col("mean_y") + F.col("slope") * (F.col("x") + F.col("ahead") - F.col("mean_day"))).alias("yhat"),
    )
    error = F.col("y") - F.col("yhat")
    met = forecasts.join(observed(series).select("series_key", "date", "y"), ["series_key", "date"])
    return met.groupBy("series_key", "ahead").agg(
        F.count("*").alias("origins"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse")
    )


def sales_and_profit(forecasts: DataFrame) -> DataFrame:
    """The two summary series side by side: (date, forecasted_sales, forecasted_profit)."""

    def target(key: str) -> Column:
        return F.max(F.when(F.col("series_key") == key, F.col("yhat")))

    return (
        forecasts.groupBy("date")
        .agg(
            target("total_sales").alias("forecasted_sales"),
            target("total_profit").alias("forecasted_profit"),
        )
        .orderBy("date")
    )
