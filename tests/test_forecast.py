import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from headroom.config import ForecastParams
from headroom.operators.forecast import fit_from_cells, fit_linear, fit_seasonal, forecast_all, forecast_linear, \
    forecast_seasonal, forecast_status, season_cells
from tests.conftest import d
from tests.frames import SERIES, series_df


def _pd(df, h=None):
    if h is not None:
        df = df.where(F.col("horizon_weeks") == h)
    return df.orderBy("resource_id", "horizon_weeks", "step").toPandas()


def test_linear_shapes_and_values(spark):
    y = np.linspace(50, 80, 60)
    s = series_df(spark, "r1", [d(i) for i in range(60)], list(y))
    f = forecast_linear(s, [4, 12])
    f4, f12 = _pd(f, 4), _pd(f, 12)
    assert len(f4) == 28 and len(f12) == 84
    assert f4["yhat"].iloc[-1] > 80
    assert (f4["yhat_lower"] <= f4["yhat"]).all() and (f4["yhat"] <= f4["yhat_upper"]).all()
    b, a = np.polyfit(np.arange(60), y, 1)
    np.testing.assert_allclose(f12["yhat"], a + b * np.arange(60, 144), rtol=1e-10)
    assert f4["ds"].iloc[0] == d(60) and f12["ds"].iloc[-1] == d(143)
    # truncation: the 4-week rows equal the first 28 of the 12-week rows
    np.testing.assert_allclose(f4["yhat"], f12["yhat"].iloc[:28])


def test_linear_sigma_is_population_std(spark):
    rng = np.random.default_rng(3)
    y = 10 + 0.5 * np.arange(30) + rng.normal(0, 2, 30)
    s = series_df(spark, "r1", [d(i) for i in range(30)], list(y))
    fit = fit_linear(s).first()
    b, a = np.polyfit(np.arange(30), y, 1)
    sigma = float(np.std(y - (a + b * np.arange(30))))
    assert abs(fit.sigma - sigma) < 1e-9 and abs(fit.slope - b) < 1e-12 and abs(fit.intercept - a) < 1e-9
    f = _pd(forecast_linear(s, [4]))
    np.testing.assert_allclose(f["yhat_upper"] - f["yhat"], 1.96 * sigma, rtol=1e-9)


def test_one_point_and_empty(spark):
    one = series_df(spark, "r1", [d(0)], [50.0])
    assert forecast_all(one).count() == 0
    st = {(r.model, r.status) for r in forecast_status(one).collect()}
    assert st == {("linear_regression", "too_few_points"), ("seasonal", "too_few_points")}
    empty = spark.createDataFrame([], SERIES)
    assert forecast_all(empty).count() == 0 and forecast_status(empty).count() == 0


def test_missing_y_blocks_linear_only(spark):
    y = list(np.linspace(40, 70, 30))
    y[5] = None
    s = series_df(spark, "r1", [d(i) for i in range(30)], y)
    assert forecast_linear(s).count() == 0
    st = {(r.model, r.status) for r in forecast_status(s).collect()}
    assert st == {("linear_regression", "missing_y"), ("seasonal", "ok")}
    assert forecast_seasonal(s, [4]).count() == 28


def test_forecast_starts_day_after_last_date_with_gaps(spark):
    s = series_df(spark, "r1", [d(0), d(1), d(9)], [1.0, 2.0, 3.0])
    f = _pd(forecast_linear(s, [4]))
    assert f["ds"].iloc[0] == d(10)
    # t continues from the row index, not the calendar: t* = 2 + step
    fit = fit_linear(s).first()
    assert abs(f["yhat"].iloc[0] - (fit.intercept + fit.slope * 3)) < 1e-12


def test_empty_horizon_list_means_default(spark):
    s = series_df(spark, "r1", [d(i) for i in range(10)], [float(i) for i in range(10)])
    assert {r.horizon_weeks for r in forecast_linear(s, []).select("horizon_weeks").distinct().collect()} == {4, 12}


def _seasonal_reference(y, dates, yearly_min=365):
    """The seasonal definition written out with pandas, independent of the Spark code."""
    df = pd.DataFrame({"y": y, "ds": pd.to_datetime(dates)})
    df["t"] = np.arange(len(df))
    m = df["y"].notna()
    b, a = np.polyfit(df.loc[m, "t"], df.loc[m, "y"], 1)
    df["r"] = df["y"] - (a + b * df["t"])
    df["dow"] = (df["ds"].dt.dayofweek + 1) % 7 + 1  # Sunday = 1
    wk = df.groupby("dow")["r"].mean()
    df["r2"] = df["r"] - df["dow"].map(wk)
    df["mon"] = df["ds"].dt.month
    mo = df.groupby("mon")["r2"].mean() if len(df) >= yearly_min else pd.Series(dtype=float)
    df["e"] = df["r2"] - df["mon"].map(mo).fillna(0.0)
    sigma = float(np.nanstd(df["e"]))
    fut = pd.date_range(df["ds"].max() + pd.Timedelta(days=1), periods=84, freq="D")
    fdow = (fut.dayofweek + 1) % 7 + 1
    yhat = a + b * (len(df) - 1 + np.arange(1, 85)) + pd.Series(fdow).map(wk).fillna(0).values + \
        pd.Series(fut.month).map(mo).fillna(0).values
    return yhat, sigma


def test_weekly_sine_seasonal_matches_definition(spark):
    i = np.arange(90)
    y = 50 + np.linspace(0, 20, 90) + 3 * np.sin(2 * np.pi * i / 7)
    dates = [d(k) for k in range(90)]
    s = series_df(spark, "r1", dates, list(y))
    f = forecast_seasonal(s, [4, 12])
    f4, f12 = _pd(f, 4), _pd(f, 12)
    assert len(f4) == 28 and len(f12) == 84 and set(f12["model_used"]) == {"seasonal"}
    want, sigma = _seasonal_reference(y, dates)
    np.testing.assert_allclose(f12["yhat"], want, rtol=1e-9)
    np.testing.assert_allclose(f12["yhat_upper"] - f12["yhat"], 1.96 * sigma, rtol=1e-6, atol=1e-9)
    # the weekly pattern is captured: seasonal residual spread well below the linear one
    assert fit_seasonal(s).first().sigma < 0.5 * fit_linear(s).first().sigma


def test_yearly_term_from_365_points(spark):
    n = 400
    i = np.arange(n)
    dates = [d(k, "2024-01-01") for k in range(n)]
    y = 30 + 0.01 * i + 5 * np.array([dt.month for dt in dates]) / 12 + np.cos(i)
    s = series_df(spark, "r1", dates, list(y))
    want, _ = _seasonal_reference(y, dates)
    got = _pd(forecast_seasonal(s, [12]))["yhat"]
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_short_series_falls_back_to_linear(spark):
    s = series_df(spark, "r1", [d(i) for i in range(10)], [float(i) * 2 for i in range(10)])
    f = _pd(forecast_seasonal(s, [4], ForecastParams(seasonal_min_points=14)))
    lin = _pd(forecast_linear(s, [4]))
    assert set(f["model_used"]) == {"linear_regression"}
    np.testing.assert_allclose(f["yhat"], lin["yhat"], rtol=1e-12)
    assert {(r.model, r.status) for r in forecast_status(s, ForecastParams(seasonal_min_points=14)).collect()} == \
        {("linear_regression", "ok"), ("seasonal", "fallback_linear")}


def test_two_resources_both_present(spark):
    y = list(np.linspace(40, 70, 60))
    s = series_df(spark, "a", [d(i) for i in range(60)], y).unionByName(
        series_df(spark, "b", [d(i) for i in range(60)], y))
    out = forecast_all(s).groupBy("resource_id", "model").count().collect()
    assert {(r.resource_id, r.model, r["count"]) for r in out} == {
        ("a", "linear_regression", 112), ("a", "seasonal", 112), ("b", "linear_regression", 112), ("b", "seasonal", 112)}


def test_params_min_points(spark):
    s = series_df(spark, "r1", [d(i) for i in range(20)], [float(i % 7) for i in range(20)])
    assert set(_pd(forecast_seasonal(s, [4], ForecastParams(seasonal_min_points=30)))["model_used"]) == {"linear_regression"}


def test_forecast_peaks_equal_exploded_peaks(spark):
    from headroom.operators.forecast import forecast_peaks
    from headroom.operators.rules import horizon_peaks
    i = np.arange(120)
    y = list(60 + 0.1 * i + 4 * np.sin(2 * np.pi * i / 7))
    s = series_df(spark, "r1", [d(k) for k in range(120)], y).unionByName(
        series_df(spark, "r2", [d(0)], [5.0]))
    for model, fc in (("linear_regression", forecast_linear(s)), ("seasonal", forecast_seasonal(s))):
        direct = {r.resource_id: (r.current_value, r.peak_4, r.peak_12) for r in forecast_peaks(s, model).collect()}
        exploded = {r.resource_id: (r.peak_4, r.peak_12) for r in horizon_peaks(fc, model).collect()}
        assert direct["r1"][1:] == exploded["r1"]
        assert direct["r1"][0] == y[-1]
        assert direct["r2"] == (5.0, None, None) and "r2" not in exploded


def test_select_model_prefers_seasonal_on_weekly_pattern(spark):
    from headroom.operators.forecast import select_model
    i = np.arange(120)
    seasonal = list(50 + 10 * np.sin(2 * np.pi * i / 7))
    line = list(10 + 0.5 * i)
    s = series_df(spark, "weekly", [d(k) for k in range(120)], seasonal).unionByName(
        series_df(spark, "line", [d(k) for k in range(120)], line))
    rows = {(r.resource_id, r.model): r for r in select_model(s).collect()}
    assert rows[("weekly", "seasonal")].selected and not rows[("weekly", "linear_regression")].selected
    assert rows[("weekly", "seasonal")].mae < 0.25 * rows[("weekly", "linear_regression")].mae
    assert rows[("weekly", "seasonal")].n_holdout == 28
    # an exact line: both models are exact, the tie goes to the model name
    assert rows[("line", "linear_regression")].selected and rows[("line", "linear_regression")].mae < 1e-9


def test_prophet_slot_is_the_linear_forecast(spark):
    from headroom.operators.forecast import forecast_prophet
    y = list(np.linspace(50, 80, 60))
    s = series_df(spark, "r1", [d(i) for i in range(60)], y)
    p = _pd(forecast_prophet(s))
    lin = _pd(forecast_linear(s))
    assert set(p["model"]) == {"prophet"} and set(p["model_used"]) == {"linear_regression"}
    np.testing.assert_allclose(p["yhat"], lin["yhat"], rtol=1e-12)


def test_forecast_all_single_pass_matches_each_model(spark):
    from headroom.operators.forecast import forecast_all
    i = np.arange(80)
    y = list(40 + 0.3 * i + 2 * np.sin(2 * np.pi * i / 7))
    s = series_df(spark, "r1", [d(k) for k in range(80)], y).unionByName(
        series_df(spark, "r2", [d(k) for k in range(10)], [float(k) for k in range(10)]))
    allf = forecast_all(s, [4, 12], models=("linear_regression", "prophet", "seasonal"))
    for model, single in (("linear_regression", forecast_linear(s)), ("seasonal", forecast_seasonal(s))):
        a = _pd(allf.where(F.col("model") == model))
        b = _pd(single)
        assert len(a) == len(b) and list(a["model_used"]) == list(b["model_used"])
        np.testing.assert_allclose(a["yhat"], b["yhat"], rtol=1e-10)
        np.testing.assert_allclose(a["yhat_upper"], b["yhat_upper"], rtol=1e-9)
    p = _pd(allf.where(F.col("model") == "prophet"))
    np.testing.assert_allclose(p["yhat"], _pd(forecast_linear(s))["yhat"], rtol=1e-10)


def test_seasonal_model_from_two_points(spark):
    """No switch on the length of a series but the two points a fit needs."""
    s = series_df(spark, "one", [d(0)], [1.0])
    for n in (2, 13, 14):
        s = s.unionByName(series_df(spark, f"n{n}", [d(i) for i in range(n)], [2.0 * i for i in range(n)]))
    p = _pd(forecast_seasonal(s, [1]))
    assert set(p["resource_id"]) == {"n2", "n13", "n14"} and set(p["model_used"]) == {"seasonal"}
    for n in (2, 13, 14):  # an exact line: no weekday effect, seen or unseen
        np.testing.assert_allclose(p[p["resource_id"] == f"n{n}"]["yhat"], 2.0 * np.arange(n, n + 7), atol=1e-9)


def _season_series(spark, seed=4, days=800, resources=3):
    import random
    rng = random.Random(seed)
    rows = []
    for k in range(resources):
        t = 0
        for i in range(days):
            if rng.random() < 0.85:
                y = None if rng.random() < 0.1 else 50 + 0.03 * i + 3 * math.sin(i * 2 * math.pi / 7) + (i // 30 % 12) + rng.gauss(0, 1)
                rows.append(("compute", f"r{k}", d(i), y, t))
                t += 1
    return spark.createDataFrame(rows, "resource_type string, resource_id string, ds date, y double, t long")


def test_season_cells_of_two_halves_merge(spark):
    s = _season_series(spark)
    early = F.col("ds") < F.lit(d(300))
    parts = season_cells(s.where(early)).unionByName(season_cells(s.where(~early)))
    whole = {r.resource_id: r for r in fit_from_cells(season_cells(s)).collect()}
    merged = {r.resource_id: r for r in fit_from_cells(parts).collect()}
    assert season_cells(s).groupBy("resource_id").count().agg(F.max("count")).first()[0] <= 84
    assert whole.keys() == merged.keys() and len(whole) == 3
    for k, w in whole.items():
        for c in w.asDict():
            a, b = w[c], merged[k][c]
            if isinstance(a, (float, list)):
                np.testing.assert_allclose(np.array(b, dtype=float), np.array(a, dtype=float), rtol=1e-9, atol=1e-9)
            else:
                assert a == b, c


def test_season_fit_equals_its_definition(spark):
    s = _season_series(spark, seed=9, resources=2)
    p = s.toPandas().dropna(subset=["y"])
    for r in fit_from_cells(season_cells(s)).collect():
        g = p[p.resource_id == r.resource_id].copy()
        b, a = np.polyfit(g.t, g.y, 1)
        g["r"] = g.y - a - b * g.t
        g["dow"], g["mon"] = [(x.isoweekday() % 7) + 1 for x in g.ds], [x.month for x in g.ds]
        week = g.groupby("dow").r.mean()
        g["r2"] = g.r - g.dow.map(week)
        month = g.groupby("mon").r2.mean()
        left = g.r2 - g.mon.map(month)
        np.testing.assert_allclose([r.intercept, r.slope, r.sigma], [a, b, left.std(ddof=0)], rtol=1e-8)
        np.testing.assert_allclose(r.weekday_effect, week.sort_index(), rtol=1e-7, atol=1e-9)
        np.testing.assert_allclose(r.month_effect, month.sort_index(), rtol=1e-7, atol=1e-9)


def test_season_fit_adds_no_window_and_no_shuffle(spark):
    from tests.test_plans import plan
    from __spark_entry__ import queries
    def count(name, what):
        return len(re.findall(rf"^\(\d+\) {what}", plan(queries()[name](spark, "/root/testdata/sf0.001")), re.M))
    for what in ("Window", "Exchange", "Sort "):
        assert count("seasonal_forecast", what) == count("series_index", what), what


def test_forecast_all_fits_each_resource_once_and_status_fits_nothing(spark):
    from headroom.operators.forecast import forecast_all, forecast_status
    s = series_df(spark, "r1", [d(k) for k in range(80)], [float(k % 9) for k in range(80)])
    s = s.unionByName(series_df(spark, "one", [d(0)], [1.0]))

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    def rows(df):
        return sorted(map(tuple, df.collect()))

    assert plan(forecast_all(s)).count("collect_list") == plan(forecast_seasonal(s)).count("collect_list")
    assert "collect_list" not in plan(forecast_status(s)) and "regr_" not in plan(forecast_status(s))
    assert rows(forecast_all(s, [4], spread=5)) == rows(forecast_all(s, [4])) and forecast_all(s, [4], spread=5).rdd.getNumPartitions() == 5
