"""Registered queries over the benchmark tables.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole tables.
Output columns are plain strings, dates, bigints and doubles; doubles are rounded (same
formula as the SQL twin in :mod:`headroom.plans.oracle`) so results can be compared
across engines. Regression-derived numbers use 4 decimals, plain means 6.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.config import CRITICAL, WARNING, ForecastParams
from headroom.functions.numeric import round_to
from headroom.operators import cleaning, export, forecast, narrative, rules, series, trends
from headroom.schemas import COMPUTE, KINDS, NETWORK, STORAGE
from headroom.sources import adapters
from headroom.sources.files import dq_report

Query = Callable[[SparkSession, str], DataFrame]


def r6(c) -> Column:
    return round_to(c, 6)


def r4(c) -> Column:
    return round_to(c, 4)


def ts_text(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ---- shared building blocks ----------------------------------------------------------------

# Raw tables as the cleaning path reads them: network orders are reduced to the first order
# per (day, link) before the customer lookup (same cleaned rows, far smaller join).
RAW = {"compute": adapters.raw_compute, "storage": adapters.raw_storage,
       "network": lambda spark, sf_dir: adapters.raw_network(spark, sf_dir, dedupe_before_lookup=True)}
ALL_KINDS = ("compute", "storage", "network")


def cleaned(spark: SparkSession, sf_dir: str, kinds=ALL_KINDS) -> dict[str, DataFrame]:
    return {name: cleaning.CLEANERS[name](RAW[name](spark, sf_dir)) for name in kinds}


def trend_tables(spark: SparkSession, sf_dir: str, kinds=ALL_KINDS) -> dict[str, DataFrame]:
    return {name: trends.TREND_BUILDERS[name](df) for name, df in cleaned(spark, sf_dir, kinds).items()}


def daily_tables(spark: SparkSession, sf_dir: str, kinds=ALL_KINDS) -> dict[str, DataFrame]:
    """Daily means only: what the series, rules and overview read from the trend tables."""
    return {name: trends.aggregate_daily(df, KINDS[name].id_col, KINDS[name].daily_cols)
            for name, df in cleaned(spark, sf_dir, kinds).items()}


def series_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.prepare_all(daily_tables(spark, sf_dir))


def _recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.recommend(daily_tables(spark, sf_dir))


def _flat_recs(recs: DataFrame, *extra: str) -> DataFrame:
    keys = F.map_keys("details")
    return recs.select(
        *extra, "resource_id", "resource_type", "recommendation_type", "risk_level",
        r4("current_value").alias("current_value"), r4("forecasted_value").alias("forecasted_value"),
        F.col("forecast_horizon_weeks").cast("long").alias("forecast_horizon_weeks"),
        F.get(keys, 0).alias("detail_key"), F.get(F.map_values("details"), 0).alias("detail_value"))


# ---- queries -----------------------------------------------------------------------------

def q_dq_violations(spark, sf_dir):
    return dq_report(adapters.raw_all(spark, sf_dir))


def q_dedupe_first(spark, sf_dir):
    d = cleaning.dedupe_first(adapters.raw_compute(spark, sf_dir), COMPUTE.dedupe_keys)
    return d.select(ts_text("timestamp").alias("timestamp"), "cluster_id", "seq",
                    *[r6(c).alias(c) for c in COMPUTE.daily_cols])


def _clean_query(kind):
    def q(spark, sf_dir):
        df = cleaned(spark, sf_dir, [kind.name])[kind.name]
        values = [c for c in kind.columns[2:]]
        return df.select(ts_text("timestamp").alias("timestamp"), kind.id_col, *[r6(c).alias(c) for c in values])
    return q


def _daily_query(kind):
    def q(spark, sf_dir):
        raw = RAW[kind.name](spark, sf_dir)
        d = trends.aggregate_daily(cleaning.CLEANERS[kind.name](raw), kind.id_col, kind.daily_cols)
        return d.select(kind.id_col, "date", *[r6(c).alias(c) for c in kind.daily_cols])
    return q


def _trends_query(kind):
    def q(spark, sf_dir):
        t = trend_tables(spark, sf_dir, [kind.name])[kind.name]
        cols = list(kind.daily_cols) + [f"{kind.target}_ma7", f"{kind.target}_ma30", f"{kind.target}_growth_rate"]
        return t.select(kind.id_col, "date", *[r6(c).alias(c) for c in cols])
    return q


def q_series_index(spark, sf_dir):
    s = series_table(spark, sf_dir)
    return s.select("resource_type", "resource_id", "ds", r6("y").alias("y"), "t")


def q_resource_counts(spark, sf_dir):
    return series.resource_counts(series_table(spark, sf_dir))


def q_linear_fit(spark, sf_dir):
    f = forecast.fit_linear(series_table(spark, sf_dir))
    return f.select("resource_type", "resource_id", "n", "n_y", r4("intercept").alias("intercept"),
                    r6("slope").alias("slope"), r4("sigma").alias("sigma"), "max_t", "max_ds", "status")


def _forecast_cols(f: DataFrame) -> DataFrame:
    return f.select("resource_type", "resource_id", "model", "model_used",
                    F.col("horizon_weeks").cast("long").alias("horizon_weeks"), F.col("step").cast("long").alias("step"),
                    "ds", r4("yhat").alias("yhat"), r4("yhat_lower").alias("yhat_lower"),
                    r4("yhat_upper").alias("yhat_upper"))


def q_linear_forecast(spark, sf_dir):
    return _forecast_cols(forecast.forecast_linear(series_table(spark, sf_dir)))


def q_seasonal_forecast(spark, sf_dir):
    return _forecast_cols(forecast.forecast_seasonal(series_table(spark, sf_dir)))


# Series with fewer present values get the linear stand-in.
FALLBACK_MIN_POINTS = 300


def q_seasonal_fallback(spark, sf_dir):
    params = ForecastParams(seasonal_min_points=FALLBACK_MIN_POINTS)
    return _forecast_cols(forecast.forecast_seasonal(series_table(spark, sf_dir), params=params))


def q_missing_days(spark, sf_dir):
    return series.missing_days(series_table(spark, sf_dir))


def q_forecast_all(spark, sf_dir):
    return _forecast_cols(forecast.forecast_all(series_table(spark, sf_dir)))


def q_prophet_forecast(spark, sf_dir):
    return _forecast_cols(forecast.forecast_prophet(series_table(spark, sf_dir)))


def q_forecast_status_series(spark, sf_dir):
    return forecast.forecast_status(series_table(spark, sf_dir))


def q_forecast_status(spark, sf_dir):
    s = series_table(spark, sf_dir)
    # Variant with injected missing values: clusters whose id ends in 3 lose y on the 15th of each month.
    hole = (F.col("resource_id").like("cluster-%3")) & (F.dayofmonth("ds") == 15)
    s = s.withColumn("y", F.when(hole, F.lit(None).cast("double")).otherwise(F.col("y")))
    return forecast.forecast_status(s)


def q_select_model(spark, sf_dir):
    m = forecast.select_model(series_table(spark, sf_dir))
    return m.select("resource_type", "resource_id", "model", r4("mae").alias("mae"), "n_holdout", "selected")


def q_horizon_peaks(spark, sf_dir):
    t = trend_tables(spark, sf_dir, ["storage"])
    s = series.prepare_series(t["storage"], STORAGE.id_col, "date", STORAGE.target, "storage")
    cur = rules.latest_value(t["storage"], STORAGE.id_col, STORAGE.target)
    j = rules.attach_forecast(cur, rules.horizon_peaks(forecast.forecast_linear(s)))
    return j.select("resource_id", r4("current_value").alias("current_value"), r4("peak_4").alias("peak_4"),
                    r4("peak_12").alias("peak_12"))


def q_recommend_storage(spark, sf_dir):
    t = trend_tables(spark, sf_dir, ["storage"])
    s = series.prepare_series(t["storage"], STORAGE.id_col, "date", STORAGE.target, "storage")
    return _flat_recs(rules.rule_storage(forecast.forecast_peaks(s).drop("resource_type")))


def q_recommend_compute(spark, sf_dir):
    return _flat_recs(rules.rule_compute(trend_tables(spark, sf_dir, ["compute"])["compute"]))


def q_recommend_network(spark, sf_dir):
    return _flat_recs(rules.rule_network(trend_tables(spark, sf_dir, ["network"])["network"]))


def q_recommend_network_bandwidth(spark, sf_dir):
    t = trend_tables(spark, sf_dir, ["network"])["network"].withColumn("bandwidth_mbps", F.lit(1_000_000.0))
    return _flat_recs(rules.rule_network(t, normalise_by="bandwidth"))


def q_recommendations(spark, sf_dir):
    return _flat_recs(narrative.narrate(_recs(spark, sf_dir)), "ai_narrative")


def q_narratives(spark, sf_dir):
    n = narrative.narratives_table(narrative.narrate(_recs(spark, sf_dir)))
    return n.withColumn("forecast_horizon_weeks", F.col("forecast_horizon_weeks").cast("long"))


def q_prompts(spark, sf_dir):
    p = narrative.build_prompt(_recs(spark, sf_dir))
    return p.select("resource_type", "resource_id", F.col("forecast_horizon_weeks").cast("long"), "prompt")


def derived_responses(recs: DataFrame) -> DataFrame:
    """Service responses derived from the recommendations themselves: usable text for critical
    ones, malformed JSON for warnings, whitespace-only text for the rest."""
    text = F.concat(F.lit("  "), F.col("resource_id"), F.lit(" needs attention: "), F.col("recommendation_type"),
                    F.lit(".\\n"))
    ok = F.concat(F.lit('{"candidates":[{"content":{"parts":[{"text":"'), text, F.lit('"}]}}]}'))
    blank = F.lit('{"candidates":[{"content":{"parts":[{"text":"   "}]}}]}')
    resp = (F.when(F.col("risk_level") == CRITICAL, ok).when(F.col("risk_level") == WARNING, F.lit('{"candidates": ['))
            .otherwise(blank))
    return recs.select(*narrative.NARRATIVE_KEY, resp.alias("response"))


def q_narratives_from_responses(spark, sf_dir):
    from headroom.session import fresh_path
    path = fresh_path(spark, "recommendations")  # read twice: by the responses and by the join with them
    _recs(spark, sf_dir).write.parquet(path)
    recs = spark.read.parquet(path)
    responses = derived_responses(recs)
    later = '{"candidates":[{"content":{"parts":[{"text":"~ a later answer"}]}}]}'
    repeated = responses.unionByName(responses).unionByName(
        recs.where(F.col("risk_level") == CRITICAL).select(*narrative.NARRATIVE_KEY, F.lit(later).alias("response")))
    n = narrative.narrate(recs, repeated, provider="gemini")
    return narrative.narratives_table(n).withColumn("forecast_horizon_weeks",
                                                    F.col("forecast_horizon_weeks").cast("long"))


def q_utilization_overview(spark, sf_dir):
    o = export.utilization_overview(daily_tables(spark, sf_dir))
    return o.select("resource_id", "resource_type", "date", r6("utilization_pct").alias("utilization_pct"))


def q_risk_summary(spark, sf_dir):
    return export.risk_summary(_recs(spark, sf_dir))


def q_risk_counts(spark, sf_dir):
    return rules.risk_counts(_recs(spark, sf_dir))


def q_latency_warning(spark, sf_dir):
    l = rules.latency_warning(trend_tables(spark, sf_dir, ["network"])["network"])
    return l.select("resource_id", "latency_warning_days", r6("max_daily_latency_ms").alias("max_daily_latency_ms"))


def q_stream_daily_closed(spark, sf_dir):
    from headroom.streaming.landing import stream_daily_closed
    d = stream_daily_closed(spark, sf_dir)
    return d.select("cluster_id", "date", *[r6(c).alias(c) for c in COMPUTE.daily_cols])


def q_stream_landing(spark, sf_dir):
    from headroom.streaming.landing import stream_landing
    d = stream_landing(spark, sf_dir)
    return d.select(ts_text("timestamp").alias("timestamp"), "cluster_id", "seq",
                    *[r6(c).alias(c) for c in COMPUTE.daily_cols])


def q_stream_daily_all(spark, sf_dir):
    from headroom.streaming.days import stream_daily_all
    d = stream_daily_all(spark, sf_dir)
    return d.select("cluster_id", "date", *[r6(c).alias(c) for c in COMPUTE.daily_cols])


def _trend_columns(t: DataFrame, kind) -> DataFrame:
    cols = list(kind.daily_cols) + [f"{kind.target}_ma7", f"{kind.target}_ma30", f"{kind.target}_growth_rate"]
    return t.select(kind.id_col, "date", *[r6(c).alias(c) for c in cols])


def q_stream_trends_compute(spark, sf_dir):
    from headroom.streaming.indicators import stream_trends_all
    return _trend_columns(stream_trends_all(spark, sf_dir, "compute", cleaned(spark, sf_dir, ["compute"])["compute"]), COMPUTE)


def _incremental_query(kind):
    def q(spark, sf_dir):
        from headroom.plans.increment import incremental_trends
        from headroom.session import fresh_path
        raw = RAW[kind.name](spark, sf_dir)
        return _trend_columns(incremental_trends(spark, fresh_path(spark, f"days-{kind.name}"), raw, kind), kind)
    return q


def q_end_to_end_roundtrip(spark, sf_dir):
    from headroom.plans.capacity_job import run_on_tables
    return run_on_tables(spark, sf_dir)


# The job's own files (S3-S8, E1-E5) against the same SQL as the operators.

def q_roundtrip_recommendations(spark, sf_dir):
    from headroom.plans.capacity_job import job_folder, read_export
    recs = read_export(spark, job_folder(spark, sf_dir), "recommendations",
                       "resource_id string, resource_type string, recommendation_type string, risk_level string, "
                       "current_value double, forecasted_value double, forecast_horizon_weeks int, details string, ai_narrative string")
    return _flat_recs(recs.withColumn("details", F.from_json("details", "map<string,double>")), "ai_narrative")


def q_roundtrip_overview(spark, sf_dir):
    from headroom.plans.capacity_job import job_folder, read_export
    o = read_export(spark, job_folder(spark, sf_dir), "utilization_overview",
                    "resource_id string, resource_type string, date date, utilization_pct double")
    return o.withColumn("utilization_pct", r6("utilization_pct"))


def q_roundtrip_risk_summary(spark, sf_dir):
    from headroom.plans.capacity_job import job_folder, read_export
    return read_export(spark, job_folder(spark, sf_dir), "risk_summary", "resource_type string, risk_level string, count bigint")


def q_roundtrip_forecasts(spark, sf_dir):
    from headroom.plans.capacity_job import job_folder
    return _forecast_cols(spark.read.parquet(f"{job_folder(spark, sf_dir)}/processed/forecasts"))


QUERIES: dict[str, Query] = {
    "dq_violations": q_dq_violations,
    "dedupe_first": q_dedupe_first,
    "clean_compute": _clean_query(COMPUTE),
    "clean_storage": _clean_query(STORAGE),
    "clean_network": _clean_query(NETWORK),
    "daily_compute": _daily_query(COMPUTE),
    "daily_storage": _daily_query(STORAGE),
    "daily_network": _daily_query(NETWORK),
    "trends_compute": _trends_query(COMPUTE),
    "trends_storage": _trends_query(STORAGE),
    "trends_network": _trends_query(NETWORK),
    "series_index": q_series_index,
    "resource_counts": q_resource_counts,
    "linear_fit": q_linear_fit,
    "linear_forecast": q_linear_forecast,
    "seasonal_forecast": q_seasonal_forecast,
    "prophet_forecast": q_prophet_forecast,
    "seasonal_fallback": q_seasonal_fallback,
    "missing_days": q_missing_days,
    "forecast_all": q_forecast_all,
    "forecast_status": q_forecast_status,
    "forecast_status_series": q_forecast_status_series,
    "select_model": q_select_model,
    "horizon_peaks": q_horizon_peaks,
    "recommend_storage": q_recommend_storage,
    "recommend_compute": q_recommend_compute,
    "recommend_network": q_recommend_network,
    "recommend_network_bandwidth": q_recommend_network_bandwidth,
    "recommendations": q_recommendations,
    "narratives": q_narratives,
    "prompts": q_prompts,
    "narratives_from_responses": q_narratives_from_responses,
    "utilization_overview": q_utilization_overview,
    "risk_summary": q_risk_summary,
    "risk_counts": q_risk_counts,
    "latency_warning": q_latency_warning,
    "stream_daily_closed": q_stream_daily_closed,
    "stream_landing": q_stream_landing,
    "stream_daily_all": q_stream_daily_all,
    "stream_trends_compute": q_stream_trends_compute,
    "incremental_trends_compute": _incremental_query(COMPUTE),
    "incremental_trends_storage": _incremental_query(STORAGE),
    "incremental_trends_network": _incremental_query(NETWORK),
    "end_to_end_roundtrip": q_end_to_end_roundtrip,
    "roundtrip_recommendations": q_roundtrip_recommendations,
    "roundtrip_overview": q_roundtrip_overview,
    "roundtrip_risk_summary": q_roundtrip_risk_summary,
    "roundtrip_forecasts": q_roundtrip_forecasts,
}
