"""Per-resource series in long form."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headroom.schemas import KINDS


def prepare_series(df: DataFrame, id_col: str, date_col: str, target_col: str, resource_type: str) -> DataFrame:
    """F1 + W7: (resource_type, resource_id, ds, y, t) with t the 0-based row position per resource.

    A gap in the dates does not advance ``t``. Missing ``y`` is kept; a missing id is dropped.
    """
    w = Window.partitionBy("resource_type", "resource_id").orderBy("ds")
    return (df.where(F.col(id_col).isNotNull())
            .select(F.lit(resource_type).alias("resource_type"), F.col(id_col).alias("resource_id"),
                    F.col(date_col).cast("date").alias("ds"), F.col(target_col).cast("double").alias("y"))
            .withColumn("t", (F.row_number().over(w) - 1).cast("long")))


def prepare_all(trends: Mapping[str, DataFrame]) -> DataFrame:
    """The three trend tables as one long series table (compute, storage, network)."""
    frames = [prepare_series(trends[name], KINDS[name].id_col, "date", KINDS[name].target, name)
              for name in ("compute", "storage", "network") if name in trends]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def resource_counts(series: DataFrame) -> DataFrame:
    """Number of series per resource type."""
    return series.groupBy("resource_type").agg(F.count_distinct("resource_id").alias("n_resources"))


def missing_days(series: DataFrame) -> DataFrame:
    """The days without a row between each resource's first and last: (resource_type, resource_id, ds).

    From each row the regular days (F4) up to the resource's next row, so no day that has a row is made; t
    doesn't advance over them.
    """
    key = ["resource_type", "resource_id"]
    following = F.lead("ds").over(Window.partitionBy(*key).orderBy("ds"))
    gaps = series.select(*key, "ds", following.alias("_next")).where(F.col("_next") > F.date_add("ds", 1))
    spine = time_spine(F.date_add("ds", 1), F.datediff("_next", "ds") - 1)
    return gaps.select(*key, F.explode(spine).alias("ds"))


def time_spine(start: Column | str, periods: int | Column, freq: str = "day") -> Column:
    """array of ``periods`` regular points from ``start`` (freq "day" on dates, "hour" on timestamps);
    a column of periods (days only) must be positive."""
    s = F.col(start) if isinstance(start, str) else start
    if isinstance(periods, Column):
        if freq != "day":
            raise ValueError("a column of periods needs freq 'day'")
        return F.sequence(s.cast("date"), F.date_add(s.cast("date"), periods - 1), F.expr("interval 1 day"))
    if periods <= 0:
        return F.array().cast("array<date>" if freq == "day" else "array<timestamp_ntz>")
    if freq == "day":
        return F.sequence(s.cast("date"), F.date_add(s.cast("date"), periods - 1), F.expr("interval 1 day"))
    if freq == "hour":
        ts = s.cast("timestamp_ntz")
        return F.sequence(ts, ts + F.make_dt_interval(F.lit(0), F.lit(periods - 1)), F.expr("interval 1 hour"))
    raise ValueError(f"freq must be 'day' or 'hour', got {freq!r}")
