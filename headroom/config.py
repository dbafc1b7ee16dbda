"""Parameters and fixed values shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the behaviour being matched) -------------------------------
# Recommendation types and risk levels, as emitted in the recommendation table.
INCREASE_STORAGE = "increase_storage_capacity"
DOWNSIZE_COMPUTE = "downsize_underutilized_compute"
DECOMMISSION = "decommission_orphaned_infrastructure"
ENABLE_AUTOSCALING = "enable_temporary_autoscaling"
NO_ACTION = "no_action"

CRITICAL = "critical"
WARNING = "warning"
INFO = "info"

# Forecast horizons (weeks) used when none are given, and the two horizons the storage rule
# visits, in visiting order.
DEFAULT_HORIZONS_WEEKS: tuple[int, ...] = (4, 12)
STORAGE_RULE_HORIZONS: tuple[int, ...] = (4, 12)

# Width of the forecast interval in residual standard deviations (95 %).
INTERVAL_Z = 1.96

# Seasonal model: yearly (month) effect only with at least this many points.
YEARLY_MIN_POINTS = 365
# --- end of fixed values ------------------------------------------------------------------

LINEAR = "linear_regression"
SEASONAL = "seasonal"

# Minimum non-missing points of a fit, linear or seasonal.
SEASONAL_MIN_POINTS = 2


@dataclass(frozen=True)
class Thresholds:
    """Rule thresholds; defaults are the shipped configuration."""

    storage_critical_pct: float = 90.0
    storage_warning_pct: float = 75.0
    compute_under_pct: float = 30.0
    compute_over_pct: float = 85.0
    chronic_days: int = 21
    spike_pct: float = 85.0
    min_spike_days: int = 2
    latency_warning_ms: float = 150.0


@dataclass(frozen=True)
class ForecastParams:
    horizons_weeks: tuple[int, ...] = DEFAULT_HORIZONS_WEEKS
    seasonal_min_points: int = SEASONAL_MIN_POINTS
    yearly_min_points: int = YEARLY_MIN_POINTS

    def resolved_horizons(self) -> tuple[int, ...]:
        # An empty horizon list means "use the defaults".
        return tuple(self.horizons_weeks) or DEFAULT_HORIZONS_WEEKS
