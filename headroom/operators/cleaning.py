"""Cleaning of raw metric tables.

Order matters and follows the source semantics: first-wins de-duplication happens before
missing values are dropped, so a missing first copy evicts a valid later copy.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.functions.numeric import clip, pandas_div, round_half_even
from headroom.schemas import COMPUTE, NETWORK, STORAGE, MetricKind

SEQ = "seq"

# Aggregation buffers of these types are fixed-width, which keeps min_by in a hash aggregate.
_NUMERIC = (T.DecimalType, T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_FIXED_WIDTH = _NUMERIC + (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def dedupe_first(df: DataFrame, keys: Sequence[str], order_col: str = SEQ) -> DataFrame:
    """Keep the row with the smallest ``order_col`` per key (NULL keys form one group).

    ``order_col`` must be a unique total order (the input order). This is a hash/sort
    aggregate with map-side partial aggregation: duplicates collapse before the shuffle and a
    hot key never has to fit in one task. With a numeric order column (see
    :func:`headroom.functions.numeric.packed_order` for orders of several columns) and
    fixed-width value columns each column is a ``min_by`` (hash aggregate); otherwise the first
    row is taken as one struct.
    """
    keys = list(keys)
    carried = [c for c in df.columns if c not in keys and c != order_col]
    seq = F.col(order_col)
    types = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(types[order_col], _NUMERIC) and all(isinstance(types[c], _FIXED_WIDTH) for c in carried):
        aggs = [F.min_by(c, seq).alias(c) for c in carried] + [F.min(seq).alias(order_col)]
        return df.groupBy(*keys).agg(*aggs).select(*df.columns)
    first = F.min_by(F.struct(*carried, order_col), seq).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``subset`` is missing (NULL or NaN)."""
    return df.na.drop(subset=list(subset))


def clip_columns(df: DataFrame, columns: Sequence[str], lower: float | None = None,
                 upper: float | None = None) -> DataFrame:
    """Clamp columns; missing values stay missing. Absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: clip(c, lower, upper) for c in present})


def filter_used_le_total(df: DataFrame) -> DataFrame:
    """C4: keep disk_used_gb <= disk_total_gb."""
    return df.where(F.col("disk_used_gb") <= F.col("disk_total_gb"))


def filter_latency(df: DataFrame) -> DataFrame:
    """Keep latency_ms >= 0 (zero kept)."""
    return df.where(F.col("latency_ms") >= 0)


def derive_disk_pct(df: DataFrame) -> DataFrame:
    """Recompute disk_utilization_pct = round(used / total * 100, 2), ignoring the incoming value."""
    pct = pandas_div("disk_used_gb", "disk_total_gb") * F.lit(100.0)
    return df.withColumn("disk_utilization_pct", round_half_even(pct, 2))


def _dedupe(df: DataFrame, kind: MetricKind, order_col: str) -> DataFrame:
    return dedupe_first(df, kind.dedupe_keys, order_col)


def clean_compute(df: DataFrame, order_col: str = SEQ) -> DataFrame:
    """Dedupe -> drop missing cpu/memory -> clip the three percentages to [0, 100]."""
    return (_dedupe(df, COMPUTE, order_col)
            .transform(drop_missing, COMPUTE.required)
            .transform(clip_columns, COMPUTE.daily_cols, 0.0, 100.0))


def clean_storage(df: DataFrame, order_col: str = SEQ) -> DataFrame:
    """Dedupe -> drop missing used/total -> used <= total -> recompute pct -> clip io."""
    return (_dedupe(df, STORAGE, order_col)
            .transform(drop_missing, STORAGE.required)
            .transform(filter_used_le_total)
            .transform(derive_disk_pct)
            .transform(clip_columns, ["io_utilization_pct"], 0.0, 100.0))


def clean_network(df: DataFrame, order_col: str = SEQ) -> DataFrame:
    """Dedupe -> drop missing throughput/latency -> latency >= 0 -> throughput >= 0."""
    return (_dedupe(df, NETWORK, order_col)
            .transform(drop_missing, NETWORK.required)
            .transform(filter_latency)
            .transform(clip_columns, ["throughput_mbps"], 0.0, None))


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "compute": clean_compute, "storage": clean_storage, "network": clean_network,
}


def sort_series(df: DataFrame, id_col: str, time_col: str) -> DataFrame:
    """L1: (id, time) order for a sink, as range partitions sorted within (no single-task sort)."""
    return (df.repartitionByRange(F.col(id_col).asc_nulls_last(), F.col(time_col).asc_nulls_last())
            .sortWithinPartitions(F.col(id_col).asc_nulls_last(), F.col(time_col).asc_nulls_last()))
