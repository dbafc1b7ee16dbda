"""Per-resource forecasting as Spark jobs.

A fit is a grouped aggregate over the long series table (one group per resource), the
future grid is ``explode(sequence(1, H))`` with ``H`` the longest horizon, and every shorter
horizon is a filter of the same rows (fit once, truncate). There is no driver loop and no
per-resource Python: the number of resources only changes how many groups Spark runs.

Models
------
``linear_regression``  OLS ``y = a + b*t``; interval ``yhat +- 1.96*sigma`` with sigma the
population standard deviation of the in-sample residuals (constant width, no clipping).
Needs at least 2 points and no missing ``y``.

``seasonal``  OLS trend + day-of-week effect (+ month effect with at least 365 points), all
computed from centred sums per (resource, weekday, month); interval from the
population standard deviation of what remains. Missing ``y`` are skipped. With fewer than
``seasonal_min_points`` present values the linear model stands in (``model_used`` says so).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headroom.config import INTERVAL_Z, LINEAR, SEASONAL, YEARLY_MIN_POINTS, ForecastParams

KEY = ("resource_type", "resource_id")
FORECAST_COLUMNS = ("resource_type", "resource_id", "model", "model_used", "horizon_weeks", "step", "ds",
                    "yhat", "yhat_lower", "yhat_upper")


def _linear_sigma(syy: Column, sxy: Column, sxx: Column, n: Column) -> Column:
    # Residual sum of squares of the OLS line = Syy - Sxy^2 / Sxx; population std = sqrt(SSR / n).
    # A remainder within the rounding error of Syy (points on one line) is 0; a single point has none.
    left = F.when(sxx > 0, syy - sxy * sxy / sxx)
    return F.when(left <= syy * 1e-13, F.lit(0.0)).otherwise(F.sqrt(left / n))


def linear_status(n: Column, n_y: Column) -> Column:
    return (F.when(n < 2, F.lit("too_few_points")).when(n_y < n, F.lit("missing_y")).otherwise(F.lit("ok")))


def seasonal_status(n: Column, n_y: Column, params: ForecastParams = ForecastParams()) -> Column:
    return (F.when(n < 2, F.lit("too_few_points")).when(n_y >= params.seasonal_min_points, F.lit("ok"))
            .when(n_y == n, F.lit("fallback_linear")).otherwise(F.lit("missing_y")))


def fit_linear(series: DataFrame) -> DataFrame:
    """one row per resource with the OLS fit and its eligibility ``status``."""
    n, n_y = F.count(F.lit(1)), F.count("y")
    fit = series.groupBy(*KEY).agg(
        n.alias("n"), n_y.alias("n_y"),
        F.regr_intercept("y", "t").alias("intercept"), F.regr_slope("y", "t").alias("slope"),
        F.regr_syy("y", "t").alias("_syy"), F.regr_sxy("y", "t").alias("_sxy"), F.regr_sxx("y", "t").alias("_sxx"),
        F.max("t").alias("max_t"), F.max("ds").alias("max_ds"), F.max_by("y", "ds").alias("last_y"))
    return (fit.withColumn("sigma", _linear_sigma(F.col("_syy"), F.col("_sxy"), F.col("_sxx"), F.col("n")))
            .withColumn("status", linear_status(F.col("n"), F.col("n_y")))
            .drop("_syy", "_sxy", "_sxx"))


def linear_yhat(step: Column) -> Column:
    """Linear prediction ``step`` days after the last point of a fit row."""
    return F.col("intercept") + F.col("slope") * (F.col("max_t") + step)


def seasonal_yhat(step: Column) -> Column:
    """Seasonal prediction ``step`` days ahead (linear where the fit fell back to linear)."""
    ds = F.date_add(F.col("max_ds"), step)
    wk = F.coalesce(F.element_at("weekday_effect", F.dayofweek(ds)), F.lit(0.0))
    mo = F.coalesce(F.element_at("month_effect", F.month(ds)), F.lit(0.0))
    trend = linear_yhat(step)
    return F.when(F.col("model_used") == SEASONAL, trend + wk + mo).otherwise(trend)


def _future(fit: DataFrame, horizons_weeks: Sequence[int], yhat_of) -> DataFrame:
    """Explode each eligible fit to the longest horizon and tag the horizons each step belongs to."""
    horizons = sorted({int(h) for h in horizons_weeks if int(h) > 0})
    if not horizons:  # no rows, with the columns of a forecast
        fit, horizons = fit.where(F.lit(False)), [1]
    max_days = max(horizons) * 7
    hs = F.array(*[F.lit(h) for h in horizons])
    steps = (fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(max_days))))
             .withColumn("ds", F.date_add("max_ds", F.col("step"))))
    steps = steps.withColumn("yhat", yhat_of(F.col("step")))
    return (steps.withColumn("horizon_weeks", F.explode(F.filter(hs, lambda h: F.col("step") <= h * 7)))
            .withColumn("yhat_lower", F.col("yhat") - F.lit(INTERVAL_Z) * F.col("sigma"))
            .withColumn("yhat_upper", F.col("yhat") + F.lit(INTERVAL_Z) * F.col("sigma")))


def forecast_linear(series: DataFrame, horizons_weeks: Sequence[int] | None = None) -> DataFrame:
    """linear forecasts for every eligible resource and horizon (weeks)."""
    horizons = ForecastParams(tuple(horizons_weeks or ())).resolved_horizons()
    fit = (fit_linear(series).where(F.col("status") == "ok")
           .withColumn("model", F.lit(LINEAR)).withColumn("model_used", F.lit(LINEAR)))
    return _future(fit, horizons, linear_yhat).select(*FORECAST_COLUMNS)


def season_cells(series: DataFrame) -> DataFrame:
    """F6 statistics: one row per (resource, weekday, month), at most 84 a resource.

    Per cell the points, the present ones with their means of t and y and their centred sums of
    squares and products, the last position, date and value. Cells of disjoint parts of a series
    (with t counted through) merge by union: :func:`fit_from_cells` pools whatever rows a cell has,
    so later days need no second look at earlier ones.
    """
    return series.groupBy(*KEY, F.dayofweek("ds").alias("dow"), F.month("ds").alias("mon")).agg(
        F.count(F.lit(1)).alias("n"), F.count("y").alias("n_y"), F.max("t").alias("max_t"), F.max("ds").alias("max_ds"),
        F.max_by("y", "ds").alias("last_y"), F.regr_avgx("y", "t").alias("t_mean"), F.regr_avgy("y", "t").alias("y_mean"),
        F.regr_sxx("y", "t").alias("sxx"), F.regr_sxy("y", "t").alias("sxy"), F.regr_syy("y", "t").alias("syy"))


def _pooled(value, among=None) -> Column:
    """Sum of ``value(cell)`` over a resource's cells (those ``among`` which hold)."""
    cells = F.col("_cells") if among is None else F.filter("_cells", among)
    return F.aggregate(cells, F.lit(0.0), lambda total, c: total + value(c))


def fit_from_cells(cells: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """F6/F7 fit from the statistics of :func:`season_cells`: trend, weekday and month effects and the
    spread of what remains, per resource. Exact: all sums are centred and pooled by their means."""
    moments = F.struct("dow", "mon", F.col("n_y").cast("double").alias("n"), "t_mean", "y_mean", "sxx", "sxy", "syy")
    f = cells.groupBy(*KEY).agg(
        F.sum("n").alias("n"), F.sum("n_y").alias("n_y"), F.max("max_t").alias("max_t"), F.max_by("last_y", "max_ds").alias("last_y"),
        F.max("max_ds").alias("max_ds"), F.sort_array(F.collect_list(F.when(F.col("n_y") > 0, moments))).alias("_cells"))  # 84 rows a part at most; in one order, however they come
    present = F.when(F.col("n_y") > 0, F.col("n_y").cast("double"))
    f = f.withColumns({"_t": _pooled(lambda c: c["n"] * c["t_mean"]) / present, "_y": _pooled(lambda c: c["n"] * c["y_mean"]) / present})
    dt, dy = (lambda c: c["t_mean"] - F.col("_t")), (lambda c: c["y_mean"] - F.col("_y"))
    f = f.withColumns({"_sxx": _pooled(lambda c: c["sxx"] + c["n"] * dt(c) * dt(c)), "_sxy": _pooled(lambda c: c["sxy"] + c["n"] * dt(c) * dy(c)),
                       "_syy": _pooled(lambda c: c["syy"] + c["n"] * dy(c) * dy(c))})
    f = f.withColumn("slope", F.when(F.col("_sxx") > 0, F.col("_sxy") / F.col("_sxx")))
    f = f.withColumn("intercept", F.col("_y") - F.col("slope") * F.col("_t"))

    def rest(c):  # what the trend leaves of a cell's mean
        return c["y_mean"] - F.col("intercept") - F.col("slope") * c["t_mean"]

    def on(field, value):
        return lambda c: c[field] == value

    def effect(value, among):
        n = _pooled(lambda c: c["n"], among)
        return F.when(n > 0, _pooled(value, among) / n)

    f = f.withColumn("weekday_effect", F.array(*[effect(lambda c: c["n"] * rest(c), on("dow", d)) for d in range(1, 8)]))
    weekday = lambda c: F.get(F.col("weekday_effect"), c["dow"] - 1)
    monthly = F.array(*[effect(lambda c: c["n"] * (rest(c) - weekday(c)), on("mon", m)) for m in range(1, 13)])
    f = f.withColumn("month_effect", F.when(F.col("n") >= params.yearly_min_points, monthly).otherwise(F.array_repeat(F.lit(0.0), 12)))
    left = lambda c: rest(c) - weekday(c) - F.get(F.col("month_effect"), c["mon"] - 1)
    f = f.withColumn("_left", _pooled(lambda c: c["n"] * left(c)) / present)
    b = F.col("slope")
    inside = lambda c: F.greatest(c["syy"] - 2.0 * b * c["sxy"] + b * b * c["sxx"], F.lit(0.0))
    f = f.withColumn("_sigma_e", F.sqrt(_pooled(lambda c: inside(c) + c["n"] * (left(c) - F.col("_left")) * (left(c) - F.col("_left"))) / present))
    f = f.withColumn("sigma_linear", _linear_sigma(F.col("_syy"), F.col("_sxy"), F.col("_sxx"), F.col("n")))
    seasonal_ok = F.col("n_y") >= params.seasonal_min_points
    linear_ok = (F.col("n") >= 2) & (F.col("n_y") == F.col("n"))
    return (f.withColumn("model_used", F.when(seasonal_ok, F.lit(SEASONAL)).when(linear_ok, F.lit(LINEAR)))
            .withColumn("sigma", F.when(seasonal_ok, F.col("_sigma_e")).otherwise(F.col("sigma_linear")))
            .withColumn("status", seasonal_status(F.col("n"), F.col("n_y"), params))
            # the plain linear model from the same statistics (its OLS is the trend above)
            .withColumn("linear_status", linear_status(F.col("n"), F.col("n_y")))
            .drop("_cells", "_t", "_y", "_sxx", "_sxy", "_syy", "_left", "_sigma_e"))


def fit_seasonal(series: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """F6/F7 fit: trend, weekday and month effects per resource, plus ``model_used``.

    Two hash aggregates, over (resource, weekday, month) and over the resource; both reuse the
    partitioning by resource that numbered the series, so the fit adds no shuffle and no sort.
    """
    return fit_from_cells(season_cells(series), params)


def forecast_seasonal(series: DataFrame, horizons_weeks: Sequence[int] | None = None,
                      params: ForecastParams = ForecastParams()) -> DataFrame:
    """Seasonal forecasts (linear stand-in where the seasonal model is not eligible)."""
    horizons = params.resolved_horizons() if horizons_weeks is None else ForecastParams(tuple(horizons_weeks)).resolved_horizons()
    fit = fit_seasonal(series, params).where(F.col("model_used").isNotNull()).withColumn("model", F.lit(SEASONAL))
    return _future(fit, horizons, seasonal_yhat).select(*FORECAST_COLUMNS)


def forecast_all(series: DataFrame, horizons_weeks: Sequence[int] | None = None,
                 models: Sequence[str] = (LINEAR, SEASONAL), params: ForecastParams = ForecastParams(),
                 spread: int | None = None) -> DataFrame:
    """every model slot for every resource; ineligible resources simply have no rows.

    All slots come from one pass over the series and one fit per resource: the seasonal fit's statistics
    already carry the linear OLS, so the linear (and, if asked for, the prophet) rows are the same
    fit rows projected with the linear prediction and interval. A fit row gives hundreds of forecast
    rows; with ``spread`` the series are dealt over so many tasks first and fitted where they are (for a
    written series: its rows travel once, in place of its cells, which are wider and hardly fewer, and its
    fits), else the fits come in as many tasks as their own size asks for.
    """
    horizons = params.resolved_horizons() if horizons_weeks is None else ForecastParams(tuple(horizons_weeks)).resolved_horizons()
    fit = fit_seasonal(series.repartition(spread, *KEY) if spread else series, params)

    def slot(model: str) -> Column:
        own = model == SEASONAL
        used = F.col("model_used") if own else F.when(F.col("linear_status") == "ok", F.lit(LINEAR))
        return F.struct(F.lit(model).alias("model"), used.alias("model_used"), F.col("sigma" if own else "sigma_linear").alias("sigma"))

    slots = F.filter(F.array(*[slot(m) for m in (LINEAR, PROPHET, SEASONAL) if m in models]), lambda x: x["model_used"].isNotNull())
    fit = fit.select(*KEY, "intercept", "slope", "max_t", "max_ds", "weekday_effect", "month_effect", F.explode(slots).alias("_slot"))
    fit = fit.select("*", "_slot.*").drop("_slot")
    return _future(fit, horizons, seasonal_yhat).select(*FORECAST_COLUMNS)


def forecast_status(series: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """F9 companion: (resource_type, resource_id, model, status, n, n_y) for both models.

    Both depend only on the points and present points of a resource, so nothing is fitted.
    """
    fit = series.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("n_y"))
    both = F.array(
        F.struct(F.lit(LINEAR).alias("model"), linear_status(F.col("n"), F.col("n_y")).alias("status")),
        F.struct(F.lit(SEASONAL).alias("model"), seasonal_status(F.col("n"), F.col("n_y"), params).alias("status")))
    return (fit.select(*KEY, "n", "n_y", F.explode(both).alias("_s"))
            .select(*KEY, "_s.model", "_s.status", "n", "n_y"))


def forecast_peaks(series: DataFrame, model: str = LINEAR, horizons_weeks: Sequence[int] = (4, 12),
                   params: ForecastParams = ForecastParams()) -> DataFrame:
    """Per resource: the latest value and the peak forecast of each horizon, in one pass.

    (resource_type, resource_id, current_value, peak_<h>...). The peaks are evaluated in the
    fit row with higher-order functions (``array_max`` over the horizon's steps), so there is
    no exploded forecast table and no join back to the history; an ineligible resource gets
    NULL peaks. Equal to the peaks of :func:`forecast_linear` / :func:`forecast_seasonal`.
    """
    if model == LINEAR:
        fit = fit_linear(series).withColumn("_ok", F.col("status") == "ok")
        yhat = linear_yhat
    elif model == SEASONAL:
        fit = fit_seasonal(series, params).withColumn("_ok", F.col("model_used").isNotNull())
        yhat = seasonal_yhat
    else:
        raise ValueError(f"unknown model {model!r}")
    peaks = {f"peak_{h}": F.when(F.col("_ok"), F.array_max(F.transform(F.sequence(F.lit(1), F.lit(int(h) * 7)), yhat)))
             for h in horizons_weeks}
    return fit.select(*KEY, F.col("last_y").alias("current_value"), *[c.alias(n) for n, c in peaks.items()])


def select_model(series: DataFrame, holdout_days: int = 28, models: Sequence[str] = (LINEAR, SEASONAL),
                 params: ForecastParams = ForecastParams()) -> DataFrame:
    """Extension: hold-out error of each model per resource and the model to use.

    The last ``holdout_days`` calendar days of each series are held out, every model is fit on
    the rest and forecast over them; ``mae`` is the mean absolute error on the held-out days
    that have a value. One row per (resource, model): mae, n_holdout, selected (lowest mae,
    ties to the model name). A resource whose training part is not eligible has no rows.
    """
    w = Window.partitionBy(*KEY)
    s = series.withColumn("_cut", F.date_sub(F.max("ds").over(w), holdout_days))
    train = s.where(F.col("ds") <= F.col("_cut")).drop("_cut")
    hold = s.where((F.col("ds") > F.col("_cut")) & F.col("y").isNotNull()).select(*KEY, "ds", F.col("y").alias("_y"))
    weeks = -(-holdout_days // 7)
    f = forecast_all(train, [weeks], models, params)
    err = (f.join(hold, on=[*KEY, "ds"]).groupBy(*KEY, "model")
           .agg(F.avg(F.abs(F.col("yhat") - F.col("_y"))).alias("mae"), F.count(F.lit(1)).alias("n_holdout")))
    # Models within 1e-9 of each other tie (float noise between fits); ties go to the model name.
    rounded = F.rint(F.col("mae") * F.lit(1e9)) / F.lit(1e9)
    best = F.min(F.struct(rounded, F.col("model"))).over(Window.partitionBy(*KEY))
    return err.withColumn("selected", best["model"] == F.col("model"))


PROPHET = "prophet"


def forecast_prophet(series: DataFrame, horizons_weeks: Sequence[int] | None = None) -> DataFrame:
    """The ``prophet`` slot: the linear forecast under that name, what the source does where the
    Prophet package is missing. The seasonal model of this library is ``forecast_seasonal``."""
    return forecast_linear(series, horizons_weeks).withColumn("model", F.lit(PROPHET)).select(*FORECAST_COLUMNS)
