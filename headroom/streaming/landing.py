"""Incremental ingest on Structured Streaming.

* T1 ``land_stream``: pick up newly landed raw files (explicit schema), apply the row-wise
  part of cleaning, append to the interim zone (file sink, exactly-once via checkpoint).
* T2 ``stream_dedupe``: first-wins de-duplication per (timestamp, id) as a streaming
  aggregate with a watermark; the survivor is the smallest ``seq``, exactly as in batch,
  and state for a key is dropped once the watermark passes it.
* T3 ``stream_daily``: daily means per resource on 1-day tumbling windows; in append mode a
  day is emitted once closed (window end <= watermark).

Watermarks need ``timestamp`` (not ``timestamp_ntz``): the naive time is read as a UTC
instant by arithmetic, so the session time zone plays no part. Row-frame trend windows
cannot run on a stream; run them in batch over the emitted daily table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headroom.functions.timeutil import epoch_day_to_date, ntz_as_utc_instant
from headroom.operators.cleaning import SEQ, clip_columns, drop_missing
from headroom.operators.quality import TABLE_LABELS
from headroom.schemas import COMPUTE, KINDS, MetricKind
from headroom.session import fresh_path
from headroom.sources.adapters import compute_from_events
from headroom.sources.files import file_schema, normalise_missing

EVENT_TIME = "event_time"


def read_stream(spark: SparkSession, directory: str, schema, fmt: str = "parquet", glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming file source over ``directory`` (optionally only files matching ``glob``)."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        # A file whose header differs from the schema fails instead of being read by position.
        r = r.option("header", True).option("enforceSchema", False)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def row_clean(df: DataFrame, kind: MetricKind) -> DataFrame:
    """Row-wise cleaning (everything but de-duplication): drop missing, filters, clipping."""
    out = drop_missing(df, kind.required)
    if kind.name == "compute":
        return clip_columns(out, kind.daily_cols, 0.0, 100.0)
    if kind.name == "storage":
        from headroom.operators.cleaning import derive_disk_pct, filter_used_le_total
        return clip_columns(derive_disk_pct(filter_used_le_total(out)), ["io_utilization_pct"], 0.0, 100.0)
    from headroom.operators.cleaning import filter_latency
    return clip_columns(filter_latency(out), ["throughput_mbps"], 0.0, None)


def land_stream(spark: SparkSession, landing_dir: str, kind: str, out_dir: str, checkpoint: str,
                fmt: str = "csv", with_seq: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Landed raw files -> NaN->NULL -> row-wise checks -> parquet append.

    ``with_seq``: the files also carry the ``seq`` (input order) column, kept for dedupe.
    ``processing_time`` (e.g. ``"1 hour"``) keeps the stream running on that cadence; by
    default it processes what has landed and stops (``availableNow``).
    """
    from pyspark.sql import types as T

    k = KINDS[kind]
    schema = T.StructType(k.schema.fields + [T.StructField(SEQ, T.LongType(), True)]) if with_seq else k.schema
    try:  # by name: the files that have landed say where each column is
        found = file_schema(spark, landing_dir, fmt, schema, TABLE_LABELS[kind])
    except AnalysisException:  # nothing has landed yet: files must come in the order of the schema
        found = schema
    df = normalise_missing(read_stream(spark, landing_dir, found, fmt).select(*schema.names))
    writer = (row_clean(df, k).writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()


def with_event_time(df: DataFrame, delay: str) -> DataFrame:
    return df.withColumn(EVENT_TIME, ntz_as_utc_instant("timestamp")).withWatermark(EVENT_TIME, delay)


def stream_dedupe(df: DataFrame, kind: MetricKind, delay: str = "1 day", order_col: str | None = SEQ) -> DataFrame:
    """One row per (timestamp, id), the smallest ``order_col`` wins; ``df`` must carry event time.

    Without an order column (``order_col=None``) the first row to *arrive* wins
    (``dropDuplicatesWithinWatermark``); that equals the batch result only when arrival order
    is input order.
    """
    if order_col is None:
        return df.dropDuplicatesWithinWatermark(["timestamp", kind.id_col])
    carried = [c for c in df.columns if c not in (EVENT_TIME, "timestamp", kind.id_col, order_col)]
    aggs = [F.min_by(c, F.col(order_col)).alias(c) for c in carried]
    return df.groupBy(EVENT_TIME, "timestamp", kind.id_col).agg(*aggs)


def stream_daily(df: DataFrame, kind: MetricKind) -> DataFrame:
    """Daily means per resource over 1-day tumbling windows of the event time."""
    g = df.where(F.col(kind.id_col).isNotNull()).groupBy(F.window(EVENT_TIME, "1 day").alias("w"), kind.id_col)
    out = g.agg(*[F.avg(c).alias(c) for c in kind.daily_cols])
    return out.select(kind.id_col, epoch_day_to_date(F.col("w.start")).alias("date"), *kind.daily_cols)


def metric_daily_stream(spark: SparkSession, directory: str, kind: str, fmt: str = "parquet",
                        delay: str = "1 day", glob: str | None = None,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw metric files (with a ``seq`` column) as a stream -> T2 dedupe -> row-wise cleaning -> T3."""
    from pyspark.sql import types as T

    k = KINDS[kind]
    schema = T.StructType(k.schema.fields + [T.StructField(SEQ, T.LongType(), True)])
    src = normalise_missing(read_stream(spark, directory, schema, fmt, glob, max_files_per_trigger))
    deduped = stream_dedupe(with_event_time(src, delay), k, delay)
    return stream_daily(row_clean(deduped, k), k)


def compute_daily_stream(spark: SparkSession, sf_dir: str, delay: str = "1 day") -> DataFrame:
    """Hourly compute metrics derived from the events table as a stream -> closed daily means."""
    from headroom.sources.adapters import SOURCE_SCHEMAS
    events_schema = SOURCE_SCHEMAS["events"]
    src = read_stream(spark, sf_dir, events_schema, "parquet", glob="events.parquet")
    raw = with_event_time(compute_from_events(src), delay)
    deduped = stream_dedupe(raw, COMPUTE, delay)
    return stream_daily(row_clean(deduped, COMPUTE), COMPUTE)


def start_with_state_partitions(spark: SparkSession, writer, state_partitions: int | None = None) -> StreamingQuery:
    """Start a stateful streaming query with an explicit number of state partitions.

    A streaming query fixes its shuffle/state partition count at its first start (it is kept in
    the checkpoint) and AQE does not resize it, so it is set here from the cluster's parallelism
    instead of inheriting whatever the batch jobs use; the session value is restored afterwards.
    """
    n = state_partitions or spark.sparkContext.defaultParallelism
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


def stream_daily_closed(spark: SparkSession, sf_dir: str, delay: str = "1 day",
                        state_partitions: int | None = None) -> DataFrame:
    """Run :func:`compute_daily_stream` to completion (availableNow) into the shared folder and
    return what it emitted: the closed days."""
    base = fresh_path(spark, "stream-daily")
    writer = (compute_daily_stream(spark, sf_dir, delay).writeStream.format("parquet")
              .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
              .outputMode("append").trigger(availableNow=True))
    q = start_with_state_partitions(spark, writer, state_partitions)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the compute rows derived from the events table as files in the shared folder, pick
    them up with :func:`land_stream` and return what the stream appended."""
    base = fresh_path(spark, "stream-landing")
    compute_from_events(spark.read.schema(_events_schema()).parquet(f"{sf_dir.rstrip('/')}/events.parquet")) \
        .write.parquet(f"{base}/landing")
    q = land_stream(spark, f"{base}/landing", "compute", f"{base}/interim", f"{base}/checkpoint", "parquet",
                    with_seq=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/interim")


def _events_schema():
    from headroom.sources.adapters import SOURCE_SCHEMAS
    return SOURCE_SCHEMAS["events"]
