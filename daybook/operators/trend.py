"""Piecewise-linear trend forecasts: a line whose slope may change at evenly spaced knots.

The model is the trend part of Taylor and Letham, *Forecasting at Scale* (2018). A day's hinge
terms are linear in its date between two knots, so the whole fit needs only six sums per series
and segment; those are taken by Spark. What is left per series is one row with at most 26
segments, solved in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.penalised import fit as fit_model
from daybook.operators.series import future_dates, observed, per_series, with_fits

# Number of knots, share of the history they cover, and prior scales.
MAX_KNOTS = 25
KNOT_RANGE = 0.8
LINE_PRIOR = 5.0
CHANGE_PRIOR = 0.05

MOMENTS = ["points", "u", "uu", "v", "uv", "vv"]
BOUNDS = ["first_date", "last_date", "span", "scale"]
TREND_SCHEMA = (
    "series_key string, first_date date, last_date date, span int, scale double, "
    "level double, slope double, knots array<double>, changes array<double>"
)


def trend_priors(knots: int) -> tuple[np.ndarray, np.ndarray]:
    """Normal and Laplace prior scales of level, slope and slope changes."""
    line, none = [LINE_PRIOR] * 2, [np.inf] * 2
    return np.array(line + [np.inf] * knots), np.array(none + [CHANGE_PRIOR] * knots)


def _knots(span: Column, max_knots: int) -> Column:
    """Days after the first date at which the slope may change."""
    history = F.floor((span + 1) * F.lit(KNOT_RANGE)).cast("int")
    count = F.least(F.lit(max_knots), history - 1)
    numbers = F.sequence(F.lit(1), F.greatest(count, F.lit(1)))
    return F.when(
        count > 0, F.transform(numbers, lambda j: F.bround(j * ((history - 1) / count)))
    ).otherwise(F.array().cast("array<double>"))


def scaled_days(series: DataFrame, max_knots: int = MAX_KNOTS) -> DataFrame:
    """The series with its bounds and knots on every day, and date and value scaled to at most 1.

    Days without a date or a value do not count.
    """
    peak = per_series(F.max(F.abs("y")))
    return (
        observed(series)
        .withColumns(
            {
                "first_date": per_series(F.min("date")),
                "last_date": per_series(F.max("date")),
                "scale": F.when(peak > 0, peak).otherwise(1.0),
            }
        )
        .withColumn("span", F.date_diff("last_date", "first_date"))
        .withColumns(
            {
                "knots": _knots(F.col("span"), max_knots),
                "t": F.date_diff("date", "first_date"),
                "v": F.col("y") / F.col("scale"),
            }
        )
        .withColumn("u", F.col("t") / F.greatest("span", F.lit(1)))
    )


def segment_sums(days: DataFrame) -> DataFrame:
    """Sums per series and segment between knots."""
    segment = F.size(F.filter("knots", lambda knot: knot < F.col("t")))
    u, v = F.col("u"), F.col("v")
    return (
        days.withColumn("segment", segment)
        .groupBy("series_key", *BOUNDS, "knots", "segment")
        .agg(
            F.count("v").cast("double").alias("points"),
            F.sum(u).alias("u"),
            F.sum(u * u).alias("uu"),
            F.sum(v).alias("v"),
            F.sum(u * v).alias("uv"),
            F.sum(v * v).alias("vv"),
        )
    )


def _statistics(knots: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y of (1, u, hinges) from the sums of the segments, ordered by segment.

    A hinge is zero up to its knot, so the product of two terms runs over the segments behind
    the later of their knots, where term k is ``a[k] + b[k] u``.
    """
    tail = np.cumsum(sums[::-1], axis=0)[::-1]
    a = np.concatenate(([1.0, 0.0], -knots))
    b = np.concatenate(([0.0, 1.0], np.ones(len(knots))))
    start = np.concatenate(([0, 0], np.arange(1, len(knots) + 1)))
    later = np.maximum.outer(start, start)
    n, u, uu = (tail[later, i] for i in range(3))
    gram = np.outer(a, a) * n + (np.outer(a, b) + np.outer(b, a)) * u + np.outer(b, b) * uu
    return gram, a * tail[start, 3] + b * tail[start, 4]


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One fitted row per series."""
    for batch in batches:
        levels, slopes, scaled, changes = [], [], [], []
        for series in batch.itertuples():
            knots = np.asarray(series.knots, dtype=float) / max(series.span, 1)
            sums = np.zeros((len(knots) + 1, len(MOMENTS)))
            for part in series.parts:
                sums[part["segment"]] = [part[name] for name in MOMENTS]
            points, beta = sums[:, 0].sum(), np.full(len(knots) + 2, np.nan)
            if points >= 2:
                gram, moment = _statistics(knots, sums)
                beta = fit_model(gram, moment, sums[:, 5].sum(), points, *trend_priors(len(knots)))
            levels.append(beta[0])
            slopes.append(beta[1])
            scaled.append(knots)
            changes.append(beta[2:])
        out = batch[["series_key", *BOUNDS]]
        yield out.assign(level=levels, slope=slopes, knots=scaled, changes=changes)


def fit_trend(series: DataFrame, max_knots: int = MAX_KNOTS) -> DataFrame:
    """One row per series with its trend; no values for a series of fewer than two days."""
    return (
        segment_sums(scaled_days(series, max_knots))
        .groupBy("series_key", *BOUNDS, "knots")
        .agg(F.collect_list(F.struct("segment", *MOMENTS)).alias("parts"))
        .mapInPandas(_solve, TREND_SCHEMA)
    )


def trend_at(date: Column) -> Column:
    """Value of the fitted trend, on the scale of the series."""
    u = F.date_diff(date, "first_date") / F.greatest("span", F.lit(1))
    bends = F.aggregate(
        F.zip_with("knots", "changes", lambda knot, change: change * F.greatest(u - knot, F.lit(0.0))),
        F.lit(0.0),
        lambda sum_, bend: sum_ + bend,
    )
    return F.col("scale") * (F.col("level") + F.col("slope") * u + bends)


def predict_trend(fits: DataFrame, horizon: int) -> DataFrame:
    """(series_key, date, yhat) for the days after each series."""
    yhat = trend_at(F.col("date")).alias("yhat")
    return future_dates(fits, horizon).select("series_key", "date", yhat)


def fitted_trend(series: DataFrame, fits: DataFrame) -> DataFrame:
    """(series_key, date, y, yhat) on the days of the series."""
    yhat = trend_at(F.col("date")).alias("yhat")
    return with_fits(series, fits).select("series_key", "date", "y", yhat)
