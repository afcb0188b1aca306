"""Trend forecasts with weekly and yearly seasons.

The additive model of Taylor and Letham, *Forecasting at Scale* (2018): the piecewise-linear trend
plus a Fourier series per season, each season only where the history is long enough to show it.
A series has one row per day, so its group is bounded by the calendar and is fitted in one piece;
Spark spreads the series. Forecasts are plain column expressions over the fitted coefficients.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.penalised import fit as fit_model
from daybook.operators.series import future_dates, with_fits
from daybook.operators.trend import (
    BOUNDS,
    MAX_KNOTS,
    TREND_SCHEMA,
    scaled_days,
    trend_at,
    trend_priors,
)

# Period in days, number of waves, and shortest history in days, per season.
SEASONS = {"weekly": (7.0, 3, 14), "yearly": (365.25, 10, 730)}
SEASON_PRIOR = 10.0

FIT_SCHEMA = TREND_SCHEMA + ", weekly array<double>, yearly array<double>"


def _waves(day: np.ndarray, period: float, order: int) -> np.ndarray:
    """Sines, then cosines, of the season's first ``order`` waves."""
    angle = 2 * np.pi * np.outer(day, np.arange(1, order + 1)) / period
    return np.hstack([np.sin(angle), np.cos(angle)])


def _fit_one(rows: pd.DataFrame, chosen: Sequence[str] | None) -> pd.DataFrame:
    """Coefficients of one series from its days."""
    out = rows[["series_key", *BOUNDS]].head(1)
    span = int(out["span"].iloc[0])
    u, v, day = (rows[name].to_numpy(float) for name in ("u", "v", "day"))
    knots = np.asarray(rows["knots"].iloc[0], dtype=float) / max(span, 1)
    seasons = {
        name: _waves(day, period, order)
        for name, (period, order, shortest) in SEASONS.items()
        if (span >= shortest if chosen is None else name in chosen)
    }
    x = np.column_stack([np.ones(len(u)), u, np.maximum(u[:, None] - knots, 0.0), *seasons.values()])
    normal, laplace = trend_priors(len(knots))
    waves = x.shape[1] - len(normal)
    beta = np.full(x.shape[1], np.nan)
    if len(v) >= 2:
        normal = np.append(normal, np.full(waves, SEASON_PRIOR))
        laplace = np.append(laplace, np.full(waves, np.inf))
        beta = fit_model(x.T @ x, x.T @ v, float(v @ v), len(v), normal, laplace)
    widths = [1, 1, len(knots), *(seasons[n].shape[1] if n in seasons else 0 for n in SEASONS)]
    level, slope, changes, *waves_of = np.split(beta, np.cumsum(widths)[:-1])
    parts = {"knots": knots, "changes": changes, **dict(zip(SEASONS, waves_of))}
    return out.assign(level=level, slope=slope, **{name: [part] for name, part in parts.items()})


def fit_seasonal(
    series: DataFrame, max_knots: int = MAX_KNOTS, seasons: Sequence[str] | None = None
) -> DataFrame:
    """One row per series with trend and seasons; no values for a series of fewer than two days.

    ``seasons`` names the seasons to fit. Without it each series has those that the published model
    fits by default: weekly from 14 days of history on, yearly from 730, so the model of a series
    that grows changes on that day.
    """
    if unknown := set(seasons or ()) - set(SEASONS):
        raise ValueError(f"unknown seasons: {sorted(unknown)}")
    days = scaled_days(series, max_knots).select(
        "series_key", *BOUNDS, "knots", "u", "v", F.unix_date("date").alias("day")
    )
    chosen = None if seasons is None else list(seasons)
    return days.groupBy("series_key").applyInPandas(lambda rows: _fit_one(rows, chosen), FIT_SCHEMA)


def _season_at(name: str, date: Column) -> Column:
    period, order, _ = SEASONS[name]
    angles = [F.unix_date(date) * (2 * np.pi * wave / period) for wave in range(1, order + 1)]
    values = F.array(*[F.sin(a) for a in angles], *[F.cos(a) for a in angles])
    terms = F.zip_with(name, values, lambda weight, value: F.coalesce(weight * value, F.lit(0.0)))
    return F.aggregate(terms, F.lit(0.0), lambda sum_, term: sum_ + term)


def _value_at(date: Column) -> Column:
    seasons = sum((_season_at(name, date) for name in SEASONS), F.lit(0.0))
    return trend_at(date) + F.col("scale") * seasons


def predict_seasonal(fits: DataFrame, horizon: int) -> DataFrame:
    """(series_key, date, yhat) for the days after each series."""
    yhat = _value_at(F.col("date")).alias("yhat")
    return future_dates(fits, horizon).select("series_key", "date", yhat)


def fitted_seasonal(series: DataFrame, fits: DataFrame) -> DataFrame:
    """(series_key, date, y, yhat) on the days of the series."""
    yhat = _value_at(F.col("date")).alias("yhat")
    return with_fits(series, fits).select("series_key", "date", "y", yhat)
