"""Trend indicators on a stream of closed days (W1-W3 with keyed state).

Row-frame windows are not available on streams, so each resource keeps what its next row needs: the
values of its last 29 daily rows, the last present one before them, and its newest date. State is
a few hundred bytes a resource whatever the length of the history, and lives in the checkpoint: a
restarted stream goes on where it stopped.

The input is a stream of daily rows in which every day arrives closed and each resource's days in
order, as T3 delivers them; a row that is not newer than its resource's newest date is dropped
(late days are mended in the day store, which rebuilds what follows them).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from headroom.operators.trends import aggregate_daily
from headroom.schemas import KINDS, MetricKind
from headroom.session import fresh_path
from headroom.streaming.landing import read_stream, start_with_state_partitions

KEPT_ROWS = 29
STATE = "newest date, values array<double>, known double"


def daily_schema(kind: MetricKind) -> T.StructType:
    return T.StructType([T.StructField(kind.id_col, T.StringType()), T.StructField("date", T.DateType()),
                         *[T.StructField(c, T.DoubleType()) for c in kind.daily_cols]])


def _mean(values: list) -> float | None:
    present = [v for v in values if v is not None]
    return sum(present) / len(present) if present else None


def _growth(value: float | None, before: float | None) -> float:
    """W2 with forward fill: the current value is the last present one."""
    now = before if value is None else value
    if now is None or before is None:
        return 0.0
    if before == 0:
        return 0.0 if now == 0 else math.copysign(math.inf, now)
    return now / before - 1.0


def with_indicators(daily: DataFrame, kind: str | MetricKind) -> DataFrame:
    """W3 on a stream: ``daily`` (a streaming frame of closed days) with ma7, ma30 and growth of the target."""
    k = KINDS[kind] if isinstance(kind, str) else kind
    names = [f"{k.target}_{n}" for n in ("ma7", "ma30", "growth_rate")]
    out = T.StructType([*daily_schema(k).fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest, values, known = state.get if state.exists else (None, [], None)
        values = list(values)
        rows = pd.concat(list(parts)).sort_values("date", kind="stable")
        done = []
        for row in rows.itertuples(index=False):
            row = row._asdict()
            if newest is not None and row["date"] <= newest:
                continue
            newest, value = row["date"], row[k.target]
            value = None if value is None or math.isnan(value) else float(value)
            values.append(value)
            done.append([*(row[f] for f in daily_schema(k).names), _mean(values[-7:]), _mean(values[-30:]), _growth(value, known)])
            known = known if value is None else value
            values = values[-KEPT_ROWS:]
        state.update((newest, values, known))
        yield pd.DataFrame(done, columns=out.names)

    return (daily.select(*daily_schema(k).names).where(F.col(k.id_col).isNotNull() & F.col("date").isNotNull()).groupBy(k.id_col)
            .applyInPandasWithState(step, out, STATE, "append", GroupStateTimeout.NoTimeout))


def stream_trends(spark: SparkSession, daily_dir: str, kind: str, out_dir: str, checkpoint: str,
                  state_partitions: int | None = None):
    """Closed days landing as parquet in ``daily_dir`` -> trend rows appended to ``out_dir``."""
    daily = read_stream(spark, daily_dir, daily_schema(KINDS[kind]))
    writer = (with_indicators(daily, kind).writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True))
    return start_with_state_partitions(spark, writer, state_partitions)


def stream_trends_all(spark: SparkSession, sf_dir: str, kind: str, cleaned: DataFrame, landings: int = 3) -> DataFrame:
    """The trend table of ``cleaned`` from its days landing in order, the stream restarted after each landing."""
    k, base = KINDS[kind], fresh_path(spark, "stream-trends")
    daily = aggregate_daily(cleaned, k.id_col, k.daily_cols)
    daily.write.parquet(f"{base}/days")
    daily = spark.read.schema(daily_schema(k)).parquet(f"{base}/days")
    ends = daily.agg(F.min("date").alias("low"), F.max("date").alias("high")).first()
    if ends["low"] is None:
        return spark.createDataFrame([], T.StructType([*daily_schema(k).fields, *[T.StructField(f"{k.target}_{n}", T.DoubleType()) for n in ("ma7", "ma30", "growth_rate")]]))
    span = (ends["high"] - ends["low"]).days + 1
    part = F.floor(F.datediff("date", F.lit(ends["low"])) * landings / span)
    for i in range(landings):
        daily.where(part == i).write.mode("append").parquet(f"{base}/landing")
        query = stream_trends(spark, f"{base}/landing", kind, f"{base}/trends", f"{base}/checkpoint")
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return spark.read.parquet(f"{base}/trends")
