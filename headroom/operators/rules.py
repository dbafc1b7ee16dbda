"""Threshold rules that turn history and forecasts into recommendations.

Every rule is one grouped aggregate over the (small) daily table or forecast table followed
by ``when`` chains; the storage rule builds its 0..2 outputs per resource as an array of
structs and explodes it. Output schema (fixed, also when empty):
resource_id, resource_type, recommendation_type, risk_level, current_value,
forecasted_value, forecast_horizon_weeks, details (map<string,double>).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headroom.config import (
    CRITICAL, DECOMMISSION, DOWNSIZE_COMPUTE, ENABLE_AUTOSCALING, INCREASE_STORAGE, INFO, LINEAR, NO_ACTION,
    STORAGE_RULE_HORIZONS, WARNING, Thresholds,
)
from headroom.functions.numeric import pandas_div
from headroom.operators.forecast import PROPHET, forecast_peaks, forecast_prophet
from headroom.operators.series import prepare_series
from headroom.schemas import COMPUTE, NETWORK, STORAGE, RECOMMENDATION_COLUMNS


def empty_details() -> Column:
    return F.create_map().cast("map<string,double>")


def _details(key: str, value: Column) -> Column:
    return F.create_map(F.lit(key), value.cast("double"))


def _rec(id_col: Column, rtype: str, rec_type: Column, risk: Column, current: Column, forecast: Column,
         horizon: Column, details: Column) -> list[Column]:
    return [id_col.alias("resource_id"), F.lit(rtype).alias("resource_type"), rec_type.alias("recommendation_type"),
            risk.alias("risk_level"), current.cast("double").alias("current_value"),
            forecast.cast("double").alias("forecasted_value"), horizon.cast("int").alias("forecast_horizon_weeks"),
            details.alias("details")]


def latest_value(trends: DataFrame, id_col: str, value_col: str, date_col: str = "date") -> DataFrame:
    """A3/L3: value on the last date per resource (missing allowed)."""
    return (trends.where(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("resource_id"))
            .agg(F.max_by(value_col, date_col).alias("current_value")))


def horizon_peaks(forecasts: DataFrame, model: str = LINEAR, resource_type: str = "storage") -> DataFrame:
    """Per resource, the peak ``yhat`` of each horizon the storage rule visits."""
    f = forecasts.where((F.col("model") == model) & (F.col("resource_type") == resource_type))
    return f.groupBy("resource_id").agg(
        *[F.max(F.when(F.col("horizon_weeks") == h, F.col("yhat"))).alias(f"peak_{h}") for h in STORAGE_RULE_HORIZONS])


def attach_forecast(current: DataFrame, peaks: DataFrame) -> DataFrame:
    """Left join of current values with horizon peaks; a resource without forecasts stays."""
    return current.join(peaks, on="resource_id", how="left")


def rule_storage(current: DataFrame, peaks: DataFrame | None = None, th: Thresholds = Thresholds()) -> DataFrame:
    """Visit horizon 4 then 12; critical stops, warning continues, nothing -> no_action.

    Input: (resource_id, current_value) plus a peaks table to left-join (J1), or one table
    that already carries ``peak_4``/``peak_12`` (``peaks=None``).
    """
    j = current if peaks is None else attach_forecast(current, peaks)
    crit, warn = float(th.storage_critical_pct), float(th.storage_warning_pct)

    def candidate(h: int) -> Column:
        p = F.col(f"peak_{h}")
        risk = F.when(p >= crit, F.lit(CRITICAL)).when(p >= warn, F.lit(WARNING))
        thr = F.when(p >= crit, F.lit(crit)).when(p >= warn, F.lit(warn))
        return F.struct(F.lit(h).alias("h"), p.alias("peak"), risk.alias("risk"), thr.alias("thr"))

    first, second = STORAGE_RULE_HORIZONS
    c1 = candidate(first)
    # After a critical finding at the first horizon the second one is not visited.
    c2 = F.when(c1["risk"] == CRITICAL, F.lit(None)).otherwise(candidate(second))
    found = F.filter(F.array(c1, c2), lambda x: x.isNotNull() & x["risk"].isNotNull())
    none = F.array(F.struct(F.lit(0).alias("h"), F.col("current_value").alias("peak"),
                            F.lit(None).cast("string").alias("risk"), F.lit(None).cast("double").alias("thr")))
    e = j.select("resource_id", "current_value",
                 F.explode(F.when(F.size(found) > 0, found).otherwise(none)).alias("c"))
    is_none = F.col("c.risk").isNull()
    return e.select(*_rec(
        F.col("resource_id"), "storage",
        F.when(is_none, F.lit(NO_ACTION)).otherwise(F.lit(INCREASE_STORAGE)),
        F.coalesce(F.col("c.risk"), F.lit(INFO)),
        F.col("current_value"), F.col("c.peak"), F.col("c.h"),
        F.when(is_none, empty_details()).otherwise(_details("threshold", F.col("c.thr")))))


def rule_compute(trends: DataFrame, th: Thresholds = Thresholds(), id_col: str = COMPUTE.id_col,
                 value_col: str = COMPUTE.target) -> DataFrame:
    """R2 (with A4/A5): chronic under-use first, then over-use, else no_action. One row per cluster."""
    g = (trends.where(F.col(id_col).isNotNull()).groupBy(id_col)
         .agg(F.avg(value_col).alias("avg"), F.count_if(F.col(value_col) < th.compute_under_pct).alias("below")))
    chronic = F.col("below") >= th.chronic_days
    rec_type = (F.when(chronic, F.when(F.col("avg") < th.compute_under_pct * 0.5, F.lit(DECOMMISSION))
                       .otherwise(F.lit(DOWNSIZE_COMPUTE)))
                .when(F.col("avg") >= th.compute_over_pct, F.lit(ENABLE_AUTOSCALING)).otherwise(F.lit(NO_ACTION)))
    risk = F.when(chronic, F.lit(WARNING)).when(F.col("avg") >= th.compute_over_pct, F.lit(CRITICAL)).otherwise(F.lit(INFO))
    details = F.when(chronic, _details("days_below_threshold", F.col("below"))).otherwise(empty_details())
    return g.select(*_rec(F.col(id_col), "compute", rec_type, risk, F.col("avg"), F.col("avg"), F.lit(0), details))


def share_of_peak(trends: DataFrame, id_col: str = NETWORK.id_col, value_col: str = NETWORK.target,
                  normalise_by: str = "own_peak") -> DataFrame:
    """Daily value as % of the link's own peak (default) or of its bandwidth."""
    if normalise_by == "own_peak":
        peak = F.max(value_col).over(Window.partitionBy(id_col))
    elif normalise_by == "bandwidth":
        peak = F.col("bandwidth_mbps")
    else:
        raise ValueError(f"normalise_by must be 'own_peak' or 'bandwidth', got {normalise_by!r}")
    return trends.where(F.col(id_col).isNotNull()).withColumn("pct", pandas_div(F.col(value_col), peak) * F.lit(100.0))


def rule_network(trends: DataFrame, th: Thresholds = Thresholds(), normalise_by: str = "own_peak",
                 id_col: str = NETWORK.id_col, value_col: str = NETWORK.target) -> DataFrame:
    """R3 (with A6/A7): at least ``min_spike_days`` days at or above ``spike_pct`` -> autoscaling warning."""
    g = (share_of_peak(trends, id_col, value_col, normalise_by).groupBy(id_col)
         .agg(F.count_if(F.col("pct") >= th.spike_pct).alias("spike_days"), F.avg("pct").alias("avg"),
              F.max("pct").alias("mx")))
    spike = F.col("spike_days") >= th.min_spike_days
    return g.select(*_rec(
        F.col(id_col), "network",
        F.when(spike, F.lit(ENABLE_AUTOSCALING)).otherwise(F.lit(NO_ACTION)),
        F.when(spike, F.lit(WARNING)).otherwise(F.lit(INFO)),
        F.col("avg"), F.when(spike, F.col("mx")).otherwise(F.col("avg")), F.lit(0),
        F.when(spike, _details("spike_days", F.col("spike_days"))).otherwise(empty_details())))


def recommend(trends: dict[str, DataFrame], forecasts: DataFrame | None = None, th: Thresholds = Thresholds(),
              rule_model: str = LINEAR, normalise_by: str = "own_peak") -> DataFrame:
    """Storage, compute and network recommendations in one table (no narrative yet).

    With ``forecasts`` (e.g. the written forecast table) the storage rule looks peaks up by
    resource (J1). Without, the peaks come straight from the fit of the storage series
    (:func:`forecast_peaks`), so each raw table feeds the plan once.
    """
    if forecasts is not None:
        current = latest_value(trends["storage"], STORAGE.id_col, STORAGE.target)
        storage = rule_storage(current, horizon_peaks(forecasts, rule_model), th)
    elif rule_model == PROPHET:
        s = prepare_series(trends["storage"], STORAGE.id_col, "date", STORAGE.target, "storage")
        current = latest_value(trends["storage"], STORAGE.id_col, STORAGE.target)
        storage = rule_storage(current, horizon_peaks(forecast_prophet(s, STORAGE_RULE_HORIZONS), PROPHET), th)
    else:
        s = prepare_series(trends["storage"], STORAGE.id_col, "date", STORAGE.target, "storage")
        storage = rule_storage(forecast_peaks(s, rule_model, STORAGE_RULE_HORIZONS).drop("resource_type"), None, th)
    compute = rule_compute(trends["compute"], th)
    network = rule_network(trends["network"], th, normalise_by)
    return storage.unionByName(compute).unionByName(network).select(*RECOMMENDATION_COLUMNS)


def risk_counts(recs: DataFrame) -> DataFrame:
    """Number of critical and of warning recommendations (one row)."""
    return recs.agg(F.count_if(F.col("risk_level") == CRITICAL).alias("critical_count"),
                    F.count_if(F.col("risk_level") == WARNING).alias("warning_count"))


def latency_warning(trends: DataFrame, th: Thresholds = Thresholds(), id_col: str = NETWORK.id_col) -> DataFrame:
    """Extension: days whose mean latency is at or above ``latency_warning_ms``, per link."""
    return (trends.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("resource_id"))
            .agg(F.count_if(F.col("latency_ms") >= th.latency_warning_ms).alias("latency_warning_days"),
                 F.max("latency_ms").alias("max_daily_latency_ms")))
