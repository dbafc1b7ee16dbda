"""headroom: capacity analytics for compute, storage and network utilisation series on Spark.

Every public operator is a ``DataFrame -> DataFrame`` transform built from built-in Spark
expressions (no Python UDF in the hot path), so the work is partitioned by resource and day
and planned by Catalyst.
"""

from headroom.config import DEFAULT_HORIZONS_WEEKS, ForecastParams, Thresholds
from headroom.operators.cleaning import CLEANERS, dedupe_first
from headroom.operators.export import risk_summary, utilization_overview
from headroom.operators.forecast import forecast_all, forecast_linear, forecast_seasonal, forecast_status
from headroom.operators.narrative import narrate
from headroom.operators.rules import recommend
from headroom.operators.series import prepare_all, prepare_series
from headroom.operators.trends import TREND_BUILDERS, aggregate_daily, add_trend_indicators
from headroom.plans.capacity_job import run_from_raw_dir, run_job

__all__ = [
    "DEFAULT_HORIZONS_WEEKS", "ForecastParams", "Thresholds", "CLEANERS", "dedupe_first", "risk_summary",
    "utilization_overview", "forecast_all", "forecast_linear", "forecast_seasonal", "forecast_status", "narrate",
    "recommend", "prepare_all", "prepare_series", "TREND_BUILDERS", "aggregate_daily", "add_trend_indicators",
    "run_from_raw_dir", "run_job",
]
