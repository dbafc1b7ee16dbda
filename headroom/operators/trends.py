"""Daily aggregation and trend indicators.

The daily table is tiny next to the raw data (one row per resource and day), so the
per-resource windows here shuffle only that table; all indicator columns share one window
specification and so one sort.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headroom.functions.numeric import neg_inf, pos_inf
from headroom.schemas import COMPUTE, NETWORK, STORAGE, MetricKind


def aggregate_daily(df: DataFrame, id_col: str, value_cols: Sequence[str], time_col: str = "timestamp") -> DataFrame:
    """A1: mean of each value column per (id, calendar day), missing values ignored.

    Rows with a missing id or time are dropped (they form no group); only days that occur
    are emitted. Partial aggregation runs before the shuffle, so a hot resource costs one
    partial row per task and day.
    """
    return (df.where(F.col(id_col).isNotNull() & F.col(time_col).isNotNull())
            .groupBy(F.col(id_col), F.to_date(F.col(time_col)).alias("date"))
            .agg(*[F.avg(c).alias(c) for c in value_cols]))


def rollup_daily(df: DataFrame, id_col: str, value_cols: Sequence[str], time_col: str = "timestamp") -> DataFrame:
    """A1 before its division: sum and count of each value column per (id, calendar day).

    Rollups of disjoint rows merge by adding (:func:`merge_rollups`), so rows that arrive later
    join a day without its raw rows being read again.
    """
    return (df.where(F.col(id_col).isNotNull() & F.col(time_col).isNotNull())
            .groupBy(F.col(id_col), F.to_date(F.col(time_col)).alias("date"))
            .agg(*[a for c in value_cols for a in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_count"))]))


def merge_rollups(rollups: DataFrame, id_col: str, value_cols: Sequence[str]) -> DataFrame:
    """One rollup row per (id, date) from several of disjoint rows (a union of rollups)."""
    return rollups.groupBy(id_col, "date").agg(
        *[F.sum(f"{c}_{part}").alias(f"{c}_{part}") for c in value_cols for part in ("sum", "count")])


def rollup_means(rollup: DataFrame, id_col: str, value_cols: Sequence[str]) -> DataFrame:
    """A1 from a merged rollup; a day without a present value has a missing mean."""
    return rollup.select(id_col, "date", *[F.when(F.col(f"{c}_count") > 0, F.col(f"{c}_sum") / F.col(f"{c}_count")).alias(c)
                                           for c in value_cols])


def moving_average(value_col: str, n: int, w) -> Column:
    """Mean over the current and previous n-1 rows (not days), missing values ignored."""
    return F.avg(value_col).over(w.rowsBetween(-(n - 1), Window.currentRow))


def growth_rate(value_col: str, w, fill: str = "ffill") -> Column:
    """V / previous - 1; the first row and 0/0 give 0, x/0 gives +-inf.

    ``fill="ffill"`` carries the last present value forward before dividing (the default
    behaviour of the pandas version this matches); ``fill="none"`` uses the raw values.
    """
    if fill == "ffill":
        cur = F.last(value_col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        prev = F.last(value_col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    elif fill == "none":
        cur = F.col(value_col)
        prev = F.lag(value_col, 1).over(w)
    else:
        raise ValueError(f"fill must be 'ffill' or 'none', got {fill!r}")
    return (F.when(cur.isNull() | prev.isNull(), F.lit(0.0))
            .when(prev == 0, F.when(cur == 0, F.lit(0.0)).when(cur > 0, pos_inf()).otherwise(neg_inf()))
            .otherwise(cur / prev - F.lit(1.0)))


def add_trend_indicators(df: DataFrame, id_col: str, value_col: str, order_col: str = "date",
                         fill: str = "ffill") -> DataFrame:
    """``<v>_ma7``, ``<v>_ma30`` and ``<v>_growth_rate`` per id, ordered by ``order_col``."""
    w = Window.partitionBy(id_col).orderBy(order_col)
    return df.withColumns({
        f"{value_col}_ma7": moving_average(value_col, 7, w),
        f"{value_col}_ma30": moving_average(value_col, 30, w),
        f"{value_col}_growth_rate": growth_rate(value_col, w, fill),
    })


def process_trends(df: DataFrame, kind: MetricKind, fill: str = "ffill") -> DataFrame:
    daily = aggregate_daily(df, kind.id_col, kind.daily_cols)
    return add_trend_indicators(daily, kind.id_col, kind.target, fill=fill)


def process_compute_trends(df: DataFrame, fill: str = "ffill") -> DataFrame:
    """W4."""
    return process_trends(df, COMPUTE, fill)


def process_storage_trends(df: DataFrame, fill: str = "ffill") -> DataFrame:
    """W5."""
    return process_trends(df, STORAGE, fill)


def process_network_trends(df: DataFrame, fill: str = "ffill") -> DataFrame:
    """W6."""
    return process_trends(df, NETWORK, fill)


TREND_BUILDERS = {"compute": process_compute_trends, "storage": process_storage_trends,
                  "network": process_network_trends}
