import datetime as dt
import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.functions import penalised
from daybook.operators import forecast, seasonal, trend
from daybook.operators.series import (
    event_series,
    prepare_series,
    series_info,
    summary_series,
)
from daybook.schemas import DAILY_SUMMARY
from tests.conftest import day, plain

# Ten days of known daily totals and the forecasts known for the eleventh.
SALES = [19754.31, 11895.76, 18145.19, 35869.82, 54984.32, 45407.86, 44697.77, 59369.37, 48420.10, 37896.76]
PROFIT = [8667.51, 5279.33, 8090.01, 15906.29, 24353.40, 20079.66, 19832.50, 26231.03, 21499.89, 16649.66]
LEAST_SQUARES = (59043.4833, 26112.0367)
KNOWN = (59013.1992, 26087.4121)
ORDERS = [510, 294, 484, 957, 1440, 1190, 1135, 1554, 1280, 988]


@pytest.fixture(scope="module")
def ten_days(spark):
    from decimal import Decimal

    rows = [
        (day("2024-02-01") + dt.timedelta(days=i), ORDERS[i], Decimal(f"{SALES[i]:.2f}"), Decimal(f"{PROFIT[i]:.2f}"))
        for i in range(10)
    ]
    return summary_series(spark.createDataFrame(rows, DAILY_SUMMARY))


MODELS = [
    (forecast.fit_linear, forecast.predict_linear),
    (trend.fit_trend, trend.predict_trend),
    (seasonal.fit_seasonal, seasonal.predict_seasonal),
]


def _only(df):
    (row,) = df.collect()
    return row["date"], (row["forecasted_sales"], row["forecasted_profit"])


def test_least_squares_golden(ten_days):
    date, values = _only(forecast.sales_and_profit(forecast.predict_linear(forecast.fit_linear(ten_days))))
    assert date == day("2024-02-11")
    assert values == pytest.approx(LEAST_SQUARES, abs=1e-3)


@pytest.mark.parametrize(
    "fit, predict",
    [(trend.fit_trend, trend.predict_trend), (seasonal.fit_seasonal, seasonal.predict_seasonal)],
)
def test_trend_models_are_close_to_the_known_forecast(ten_days, fit, predict):
    date, values = _only(forecast.sales_and_profit(predict(fit(ten_days), 1)))
    assert date == day("2024-02-11")
    assert values == pytest.approx(KNOWN, rel=0.002)


def test_series_info_and_preparation(ten_days):
    info = {r["series_key"]: r for r in series_info(ten_days).collect()}["total_sales"]
    assert (info["first_date"], info["last_date"], info["n_points"]) == (day("2024-02-01"), day("2024-02-10"), 10)
    assert info["mean_y"] == pytest.approx(np.mean(SALES))
    prepared = prepare_series(ten_days).filter("series_key = 'total_profit'")
    assert plain(prepared, "t", "y") == list(enumerate(PROFIT))


def test_metrics_match_numpy(ten_days):
    fitted = forecast.fitted_linear(ten_days, forecast.fit_linear(ten_days))
    found = {r["series_key"]: (r["mae"], r["mse"]) for r in forecast.forecast_metrics(fitted).collect()}
    t = np.arange(10)
    for key, y in (("total_sales", SALES), ("total_profit", PROFIT)):
        errors = np.array(y) - np.polyval(np.polyfit(t, y, 1), t)
        assert found[key] == pytest.approx((np.abs(errors).mean(), (errors**2).mean()))


def _frame(spark, rows):
    return spark.createDataFrame(rows, "series_key string, date date, y double")


def _daily(key, values, start="2020-01-01"):
    return [(key, day(start) + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]


def test_series_of_one_day_gets_dates_without_values(spark):
    series = _frame(spark, _daily("one", [5.0]) + _daily("two", [5.0, 7.0]))
    for fit, predict in MODELS:
        rows = {r["series_key"]: r for r in predict(fit(series), 1).collect()}
        assert rows["one"]["date"] == day("2020-01-02") and rows["one"]["yhat"] is None
        assert rows["two"]["yhat"] is not None


def test_days_without_a_value_do_not_count(spark):
    days = _daily("s", [10, 12, 14, 16, 18, 20])
    holes = [days[0], (*days[1][:2], None), *days[2:], ("s", day("2020-01-07"), None)]
    whole = [days[0], *days[2:]]
    for fit, predict in MODELS:
        found, expected = (plain(predict(fit(_frame(spark, days)), 2)) for days in (holes, whole))
        assert [row[:2] for row in found] == [row[:2] for row in expected]
        assert [row[2] for row in found] == pytest.approx([row[2] for row in expected])


def test_a_line_with_holes_is_fitted_exactly(spark):
    days = [(key, date, None if n % 3 == 1 else y) for n, (key, date, y) in enumerate(_daily("s", [10.0 + n for n in range(9)]))]
    series = _frame(spark, days)
    fits = forecast.fit_linear(series)
    fitted = {r["date"]: r["yhat"] for r in forecast.fitted_linear(series, fits).collect()}
    assert [fitted[date] for _, date, _ in days] == pytest.approx([10.0 + n for n in range(9)])
    (metrics,) = forecast.forecast_metrics(forecast.fitted_linear(series, fits)).collect()
    assert metrics["mae"] == pytest.approx(0, abs=1e-9)


def test_days_without_a_date_do_not_count(spark):
    days = _daily("s", [10.0, 12.0, 14.0, 16.0, 18.0])
    for fit, predict in MODELS:
        found = plain(predict(fit(_frame(spark, [*days, ("s", None, 900.0), ("s", None, None)])), 2))
        assert found == plain(predict(fit(_frame(spark, days)), 2))


def test_no_horizon_gives_no_rows(spark):
    series = _frame(spark, _daily("s", [10.0, 12.0, 14.0]))
    for fit, predict in MODELS:
        assert plain(predict(fit(series), 0)) == [] and len(plain(predict(fit(series), 1))) == 1


def test_seasons_can_be_chosen(spark):
    values = [50.0 + (20.0 if n % 7 == 3 else 0.0) for n in range(13)]
    series = _frame(spark, _daily("s", values))
    (without,) = seasonal.fit_seasonal(series).collect()
    (weekly,) = seasonal.fit_seasonal(series, seasons=["weekly"]).collect()
    assert without["weekly"] == [] and len(weekly["weekly"]) == 6 and weekly["yearly"] == []
    (none,) = seasonal.fit_seasonal(_frame(spark, _daily("s", values * 3)), seasons=[]).collect()
    assert none["weekly"] == []
    with pytest.raises(ValueError):
        seasonal.fit_seasonal(series, seasons=["monthly"])


def test_an_unfinished_search_is_an_error(monkeypatch):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 4)), rng.normal(size=40)
    arguments = (x.T @ x, x.T @ y, float(y @ y), 40, np.full(4, np.inf), np.full(4, 0.05))
    assert np.isfinite(penalised.fit(*arguments)).all()
    monkeypatch.setattr(penalised, "ROUNDS", 1)
    with pytest.raises(ArithmeticError):
        penalised.fit(*arguments)


def test_flat_zero_series_stays_at_zero(spark):
    series = _frame(spark, _daily("zero", [0.0] * 20))
    for fit, predict in ((trend.fit_trend, trend.predict_trend), (seasonal.fit_seasonal, seasonal.predict_seasonal)):
        assert [r["yhat"] for r in predict(fit(series), 2).collect()] == pytest.approx([0.0, 0.0], abs=1e-6)


def test_gaps_count_as_days(spark):
    rows = [r for r in _daily("gap", range(0, 40, 2)) if r[1].day % 3]
    (row,) = forecast.predict_linear(forecast.fit_linear(_frame(spark, rows)), 1).collect()
    following = (row["date"] - day("2020-01-01")).days
    assert row["yhat"] == pytest.approx(2.0 * following)


def test_segment_sums_give_the_statistics_of_the_full_design(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(50, 10, 60)
    series = _frame(spark, _daily("s", values))
    rows = trend.segment_sums(trend.scaled_days(series)).collect()
    knots = np.array(rows[0]["knots"]) / rows[0]["span"]
    sums = np.zeros((len(knots) + 1, 6))
    for row in rows:
        sums[row["segment"]] = [row[name] for name in trend.MOMENTS]
    gram, moment = trend._statistics(knots, sums)
    u = np.arange(60) / 59
    x = np.column_stack([np.ones(60), u, np.maximum(u[:, None] - knots, 0)])
    assert len(knots) == 25
    np.testing.assert_allclose(gram, x.T @ x, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(moment, x.T @ (values / np.abs(values).max()), rtol=1e-9)


def test_both_fits_agree_where_there_are_no_seasons(spark):
    rng = np.random.default_rng(6)
    series = _frame(spark, _daily("s", 100 + np.abs(np.arange(14) - 6) * 9 + rng.normal(0, 1, 14)))
    a = [r["yhat"] for r in trend.predict_trend(trend.fit_trend(series), 3).collect()]
    b = [r["yhat"] for r in seasonal.predict_seasonal(seasonal.fit_seasonal(series), 3).collect()]
    assert a == pytest.approx(b, rel=1e-6)


def test_trend_follows_a_bend_and_without_knots_equals_the_line(spark):
    t = np.arange(200)
    series = _frame(spark, _daily("s", 1000 + 2.0 * t + 6.0 * np.maximum(t - 100, 0)))
    (bent,) = trend.predict_trend(trend.fit_trend(series), 1).collect()
    assert bent["yhat"] == pytest.approx(1000 + 400 + 600, rel=0.02)
    (flat,) = trend.predict_trend(trend.fit_trend(series, max_knots=0), 1).collect()
    (line,) = forecast.predict_linear(forecast.fit_linear(series), 1).collect()
    assert flat["yhat"] == pytest.approx(line["yhat"], rel=1e-3)


def test_seasons_are_found_where_the_history_is_long_enough(spark):
    t = np.arange(800)
    first = dt.date(2020, 1, 1).toordinal() - dt.date(1970, 1, 1).toordinal()
    weekly = 30 * np.sin(2 * np.pi * (first + t) / 7)
    yearly = 50 * np.cos(2 * np.pi * (first + t) / 365.25)
    series = _frame(
        spark,
        _daily("long", (500 + 0.1 * t + weekly + yearly)[:793]) + _daily("short", (500 + weekly)[:14]),
    )
    fits = seasonal.fit_seasonal(series)
    sizes = {r["series_key"]: (len(r["weekly"]), len(r["yearly"])) for r in fits.collect()}
    assert sizes == {"long": (6, 20), "short": (0, 0)}
    found = seasonal.predict_seasonal(fits.filter("series_key = 'long'"), 7).orderBy("date").collect()
    assert [r["yhat"] for r in found] == pytest.approx(list((500 + 0.1 * t + weekly + yearly)[793:]), rel=0.01)
    long = series.filter("series_key = 'long'")
    (metrics,) = forecast.forecast_metrics(seasonal.fitted_seasonal(long, fits)).collect()
    assert metrics["mae"] < 2


def test_event_series_sums_decimals_per_day(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 1), 0.1), ("a", dt.datetime(2024, 1, 1, 23, 59), 0.2), ("b", dt.datetime(2024, 1, 2), 1.0)]
    events = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    found = plain(event_series(events, "k", "ts", "v"), "series_key", "date", "y")
    assert found == [("a", day("2024-01-01"), 0.3), ("b", day("2024-01-02"), 1.0)]


def test_event_series_keeps_small_values(spark):
    events = spark.range(1000).selectExpr("'a' as k", "timestamp_ntz'2024-01-01 00:00:00' as ts", "0.004d as v")
    assert plain(event_series(events, "k", "ts", "v"), "y") == [(4.0,)]
    assert plain(event_series(events, "k", "ts", "v", scale=2), "y") == [(0.0,)]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.floats(0.01, 20.0))
def test_lasso_against_all_sign_patterns(seed, strength):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(12, 5))
    hessian, target = x.T @ x, x.T @ rng.normal(size=12) * 3
    penalty = np.array([0.0, strength, strength, strength, strength])

    def cost(b):
        return 0.5 * b @ hessian @ b - target @ b + penalty @ np.abs(b)

    best = np.inf
    for pattern in itertools.product((-1, 0, 1), repeat=4):
        signs = np.array((1, *pattern))
        at = np.flatnonzero(signs)
        b = np.zeros(5)
        b[at] = np.linalg.solve(hessian[np.ix_(at, at)], (target - penalty * signs)[at])
        best = min(best, cost(b))
    found = penalised.lasso(hessian, target, penalty, np.zeros(5))
    assert cost(found) <= best + 1e-7
