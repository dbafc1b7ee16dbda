"""Table schemas and per-resource-kind metadata."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: required raw column names per table ----------------------------------
COMPUTE_COLUMNS = ("timestamp", "cluster_id", "cpu_utilization_pct", "memory_utilization_pct",
                   "cluster_utilization_pct")
STORAGE_COLUMNS = ("timestamp", "storage_id", "disk_used_gb", "disk_total_gb", "disk_utilization_pct",
                   "io_utilization_pct")
NETWORK_COLUMNS = ("timestamp", "link_id", "bandwidth_mbps", "throughput_mbps", "latency_ms")
# --- end of fixed values ------------------------------------------------------------------


def _raw_schema(columns: tuple[str, ...]) -> T.StructType:
    fields = [T.StructField("timestamp", T.TimestampNTZType(), True), T.StructField(columns[1], T.StringType(), True)]
    fields += [T.StructField(c, T.DoubleType(), True) for c in columns[2:]]
    return T.StructType(fields)


COMPUTE_SCHEMA = _raw_schema(COMPUTE_COLUMNS)
STORAGE_SCHEMA = _raw_schema(STORAGE_COLUMNS)
NETWORK_SCHEMA = _raw_schema(NETWORK_COLUMNS)


@dataclass(frozen=True)
class MetricKind:
    """What differs between the three resource kinds."""

    name: str
    id_col: str
    columns: tuple[str, ...]
    schema: T.StructType
    daily_cols: tuple[str, ...]
    target: str
    required: tuple[str, ...]

    @property
    def dedupe_keys(self) -> tuple[str, str]:
        return ("timestamp", self.id_col)


COMPUTE = MetricKind(
    name="compute",
    id_col="cluster_id",
    columns=COMPUTE_COLUMNS,
    schema=COMPUTE_SCHEMA,
    daily_cols=("cpu_utilization_pct", "memory_utilization_pct", "cluster_utilization_pct"),
    target="cluster_utilization_pct",
    required=("cpu_utilization_pct", "memory_utilization_pct"),
)
STORAGE = MetricKind(
    name="storage",
    id_col="storage_id",
    columns=STORAGE_COLUMNS,
    schema=STORAGE_SCHEMA,
    daily_cols=("disk_used_gb", "disk_total_gb", "disk_utilization_pct", "io_utilization_pct"),
    target="disk_utilization_pct",
    required=("disk_used_gb", "disk_total_gb"),
)
NETWORK = MetricKind(
    name="network",
    id_col="link_id",
    columns=NETWORK_COLUMNS,
    schema=NETWORK_SCHEMA,
    daily_cols=("bandwidth_mbps", "throughput_mbps", "latency_ms"),
    target="throughput_mbps",
    required=("throughput_mbps", "latency_ms"),
)

KINDS: dict[str, MetricKind] = {k.name: k for k in (COMPUTE, STORAGE, NETWORK)}

SERIES_SCHEMA = T.StructType([
    T.StructField("resource_type", T.StringType(), False),
    T.StructField("resource_id", T.StringType(), True),
    T.StructField("ds", T.DateType(), True),
    T.StructField("y", T.DoubleType(), True),
    T.StructField("t", T.LongType(), True),
])

RECOMMENDATION_COLUMNS = ("resource_id", "resource_type", "recommendation_type", "risk_level", "current_value",
                          "forecasted_value", "forecast_horizon_weeks", "details")
