"""Daily series in long form: (series_key, date, y), one row per series and day.

Because a day occurs once per series, the calendar bounds the rows of any one series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

VALUE_DIGITS, VALUE_SCALE = 28, 12
SUMMARY_TARGETS = ["total_sales", "total_profit"]


def summary_series(summary: DataFrame) -> DataFrame:
    """Sales and profit of the daily summary as two series."""
    return summary.unpivot(["date"], SUMMARY_TARGETS, "series_key", "amount").select(
        "series_key", "date", F.col("amount").cast("double").alias("y")
    )


def event_series(events: DataFrame, key: str, moment: str, value: str, scale: int = VALUE_SCALE) -> DataFrame:
    """Daily totals of ``value`` per key, summed as decimals so the order of rows cannot matter.

    ``scale`` is the number of decimals that single values keep; values of more are rounded to it.
    """
    exact = F.col(value).cast(T.DecimalType(VALUE_DIGITS, scale))
    return (
        events.groupBy(F.col(key).alias("series_key"), F.to_date(moment).alias("date"))
        .agg(F.sum(exact).alias("amount"))
        .select("series_key", "date", F.col("amount").cast("double").alias("y"))
    )


def series_info(series: DataFrame) -> DataFrame:
    """Period, number of points and mean of each series."""
    return series.groupBy("series_key").agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("y").alias("n_points"),
        F.avg("y").alias("mean_y"),
    )


def per_series(aggregate: Column) -> Column:
    """An aggregate over the whole series, on each of its days."""
    return aggregate.over(Window.partitionBy("series_key"))


def prepare_series(series: DataFrame) -> DataFrame:
    """Adds ``t``, the days since the first date of the series."""
    t = F.date_diff("date", per_series(F.min("date")))
    return series.select("series_key", "date", t.alias("t"), "y")


def future_dates(fits: DataFrame, horizon: int) -> DataFrame:
    """``horizon`` rows per fitted series, one for each day after its last date; none below 1."""
    ahead = F.explode(F.array(*(F.lit(n) for n in range(1, horizon + 1))).cast("array<int>"))
    return fits.withColumn("ahead", ahead).withColumn("date", F.date_add("last_date", F.col("ahead")))


def observed(series: DataFrame) -> DataFrame:
    """The days that a fit can use: those with a date and a value."""
    return series.filter(F.col("date").isNotNull() & F.col("y").isNotNull())


def with_fits(series: DataFrame, fits: DataFrame) -> DataFrame:
    """Every day with the fit of its series, a series without a key included."""
    keyed = fits.withColumnRenamed("series_key", "fit_key")
    return series.join(keyed, F.col("series_key").eqNullSafe(F.col("fit_key")))
