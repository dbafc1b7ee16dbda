"""Dashboard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.functions.numeric import pandas_div, round_half_even

OVERVIEW_COLUMNS = ("resource_id", "resource_type", "date", "utilization_pct")


def network_util_pct(throughput: str = "throughput_mbps", bandwidth: str = "bandwidth_mbps"):
    """C11: round(throughput / bandwidth * 100, 2) on daily means; bandwidth 0 -> inf or missing."""
    return round_half_even(pandas_div(F.col(throughput), F.col(bandwidth)) * F.lit(100.0), 2)


def utilization_overview(trends: dict[str, DataFrame]) -> DataFrame:
    """Compute, storage and network daily utilisation in one long table (UNION ALL).

    Compute and storage values are passed through unrounded; network is C11.
    """
    compute = trends["compute"].select(F.col("cluster_id").alias("resource_id"), F.lit("compute").alias("resource_type"),
                                       "date", F.col("cluster_utilization_pct").alias("utilization_pct"))
    storage = trends["storage"].select(F.col("storage_id").alias("resource_id"), F.lit("storage").alias("resource_type"),
                                       "date", F.col("disk_utilization_pct").alias("utilization_pct"))
    network = trends["network"].select(F.col("link_id").alias("resource_id"), F.lit("network").alias("resource_type"),
                                       "date", network_util_pct().alias("utilization_pct"))
    return compute.unionByName(storage).unionByName(network)


RISK_SUMMARY_SCHEMA = T.StructType([
    T.StructField("resource_type", T.StringType(), True),
    T.StructField("risk_level", T.StringType(), True),
    T.StructField("count", T.LongType(), False),
])


def risk_summary(recs: DataFrame) -> DataFrame:
    """A2: recommendations counted by (resource_type, risk_level); empty input -> empty table."""
    return recs.groupBy("resource_type", "risk_level").agg(F.count(F.lit(1)).alias("count"))
