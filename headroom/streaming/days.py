"""Streams of landed files into a day store: every day delivered, open days replaced.

Raw files carry no input order, but the file source knows one: modification time and path of the
file, block and row within it. Each micro-batch gets that order and is taken by a
:class:`headroom.plans.increment.DayStore` as the run of its batch number, so first-wins holds
within a batch by input order and across batches by arrival, whichever way the files fall into
batches. The store replaces the partitions of the days a batch touches: a day that is still open is
there with what has landed, and late files mend it. No watermark drops rows, and no state grows but
the store's own tables. A batch that failed is repeated under its number and replaces itself.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headroom.operators.cleaning import SEQ
from headroom.operators.quality import TABLE_LABELS
from headroom.plans.increment import DayStore
from headroom.schemas import KINDS
from headroom.session import fresh_path
from headroom.sources.adapters import raw_compute
from headroom.sources.files import file_ordinals, file_schema, normalise_missing, with_input_order
from headroom.streaming.landing import read_stream


def stream_days(spark: SparkSession, landing_dir: str, kind: str, store_dir: str, checkpoint: str, fmt: str = "csv",
                max_files_per_trigger: int | None = None, processing_time: str | None = None, grain: str = "day") -> StreamingQuery:
    """Raw files landing in ``landing_dir`` -> first-wins rows, daily means and trends of ``kind`` at
    ``store_dir``. Processes what has landed and stops, or keeps running at a cadence."""
    k = KINDS[kind]
    try:  # by name: the files that have landed say where each column is
        schema = file_schema(spark, landing_dir, fmt, k.schema, TABLE_LABELS[kind])
    except AnalysisException:  # nothing has landed yet
        schema = k.schema
    source = (read_stream(spark, landing_dir, schema, fmt, max_files_per_trigger=max_files_per_trigger)
              .select(*k.columns, F.col("_metadata.file_path").alias("_scan_path"), F.col("_metadata.file_block_start").alias("_scan_block")))

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = with_input_order(batch, file_ordinals(session, landing_dir, "landed"), "_scan_path", "_scan_block")
        DayStore(session, store_dir, kind, grain=grain).add(normalise_missing(rows.select(*k.columns, SEQ)), number)

    writer = source.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"processingTime": processing_time} if processing_time else {"availableNow": True})).start()


def finished(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_daily_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily means of the compute rows of ``sf_dir`` after they landed as CSV files without any
    order column: all days, the ones still open included.

    Two landings with a restart of the stream between them, and some rows of the first again in the
    second. All copies of a key land in one file in their order, so that the first is the table's first.
    """
    base = fresh_path(spark, "stream-days")
    raw = raw_compute(spark, sf_dir)
    share = F.pmod(F.xxhash64("timestamp", "cluster_id"), F.lit(10))
    for rows in (raw.where(share < 7), raw.where(share > 4)):
        (rows.repartition(8, "timestamp", "cluster_id").sortWithinPartitions(SEQ).drop(SEQ)
         .write.mode("append").option("header", True).csv(f"{base}/landing"))
        finished(stream_days(spark, f"{base}/landing", "compute", f"{base}/store", f"{base}/checkpoint", max_files_per_trigger=8))
    return DayStore(spark, f"{base}/store", "compute").daily()
