"""Small inline frames with explicit schemas."""

from pyspark.sql import types as T

from headroom.schemas import COMPUTE_SCHEMA, NETWORK_SCHEMA, STORAGE_SCHEMA


def with_seq(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("seq", T.LongType(), False)])


def compute_df(spark, rows):
    """rows: (timestamp, cluster_id, cpu, memory, cluster); seq = input position."""
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], with_seq(COMPUTE_SCHEMA))


def storage_df(spark, rows):
    """rows: (timestamp, storage_id, used, total, pct, io)."""
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], with_seq(STORAGE_SCHEMA))


def network_df(spark, rows):
    """rows: (timestamp, link_id, bandwidth, throughput, latency)."""
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], with_seq(NETWORK_SCHEMA))


DAILY_COMPUTE = T.StructType([
    T.StructField("cluster_id", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("cluster_utilization_pct", T.DoubleType())])
DAILY_NETWORK = T.StructType([
    T.StructField("link_id", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("bandwidth_mbps", T.DoubleType()), T.StructField("throughput_mbps", T.DoubleType()),
    T.StructField("latency_ms", T.DoubleType())])
DAILY_STORAGE = T.StructType([
    T.StructField("storage_id", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("disk_utilization_pct", T.DoubleType())])
SERIES = T.StructType([
    T.StructField("resource_type", T.StringType()), T.StructField("resource_id", T.StringType()),
    T.StructField("ds", T.DateType()), T.StructField("y", T.DoubleType()), T.StructField("t", T.LongType())])


def series_df(spark, rid, dates, ys, rtype="storage"):
    rows = [(rtype, rid, ds, None if y is None else float(y), i) for i, (ds, y) in enumerate(zip(dates, ys))]
    return spark.createDataFrame(rows, SERIES)
