import os
import tempfile

from pyspark.sql import functions as F

from headroom.operators.cleaning import clean_compute
from headroom.operators.trends import aggregate_daily
from headroom.schemas import COMPUTE
from headroom.sources.adapters import raw_compute
from headroom.streaming.landing import land_stream, stream_daily_closed

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_on_closed_days(spark):
    streamed = stream_daily_closed(spark, SF)
    batch = aggregate_daily(clean_compute(raw_compute(spark, SF)), COMPUTE.id_col, COMPUTE.daily_cols)
    last = raw_compute(spark, SF).agg(F.max("timestamp")).first()[0]
    closed = batch.where(F.date_add("date", 2).cast("timestamp_ntz") <= F.lit(last))
    key = ["cluster_id", "date"]
    s = {tuple(r[c] for c in key): r for r in streamed.collect()}
    b = {tuple(r[c] for c in key): r for r in closed.collect()}
    assert s.keys() == b.keys() and len(s) > 0
    for k in s:
        for c in COMPUTE.daily_cols:
            assert abs(s[k][c] - b[k][c]) < 1e-9


def test_land_stream_row_wise_cleaning(spark):
    base = tempfile.mkdtemp(prefix="headroom-land-")
    landing = os.path.join(base, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "batch1.csv"), "w") as f:
        f.write("timestamp,link_id,bandwidth_mbps,throughput_mbps,latency_ms\n"
                "2025-01-01 00:00:00,n1,1000,500,20\n2025-01-01 01:00:00,n1,1000,-10,-5\n"
                "2025-01-01 02:00:00,n1,1000,-10,3\n")
    q = land_stream(spark, landing, "network", os.path.join(base, "out"), os.path.join(base, "ck"))
    q.awaitTermination()
    rows = spark.read.parquet(os.path.join(base, "out")).orderBy("timestamp").collect()
    assert [r.throughput_mbps for r in rows] == [500.0, 0.0]


def test_stream_dedupe_keeps_smallest_seq_across_micro_batches(spark):
    import datetime as dt

    from headroom.schemas import COMPUTE_SCHEMA
    from headroom.streaming.landing import metric_daily_stream
    from pyspark.sql import types as T

    base = tempfile.mkdtemp(prefix="headroom-dedupe-")
    src = os.path.join(base, "landing")
    schema = T.StructType(COMPUTE_SCHEMA.fields + [T.StructField("seq", T.LongType())])
    t0 = dt.datetime(2025, 1, 1, 5)
    # first file: seq 10 with cpu 90; second file (later micro-batch): same key, seq 1, cpu 10
    spark.createDataFrame([(t0, "c1", 90.0, 1.0, 90.0, 10)], schema).write.parquet(os.path.join(src, "a"))
    spark.createDataFrame([(t0, "c1", 10.0, 1.0, 10.0, 1),
                           (dt.datetime(2025, 1, 5), "c1", 50.0, 1.0, 50.0, 2)], schema) \
        .write.parquet(os.path.join(src, "b"))
    stream = metric_daily_stream(spark, src + "/*", "compute", max_files_per_trigger=1)
    q = (stream.writeStream.format("memory").queryName("dedupe_test").outputMode("append")
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("select * from dedupe_test").collect()
    assert [(r.date.isoformat(), r.cpu_utilization_pct) for r in rows] == [("2025-01-01", 10.0)]


def test_stream_dedupe_without_order_keeps_one_row_per_key(spark):
    import datetime as dt

    from pyspark.sql import types as T

    from headroom.schemas import COMPUTE_SCHEMA
    from headroom.streaming.landing import read_stream, stream_dedupe, with_event_time

    base = tempfile.mkdtemp(prefix="headroom-dedupe-any-")
    src = os.path.join(base, "landing")
    t0 = dt.datetime(2025, 1, 1, 5)
    spark.createDataFrame([(t0, "c1", 90.0, 1.0, 90.0), (t0, "c1", 10.0, 1.0, 10.0), (t0, "c2", 5.0, 1.0, 5.0)],
                          COMPUTE_SCHEMA).coalesce(1).write.parquet(src)
    s = stream_dedupe(with_event_time(read_stream(spark, src, COMPUTE_SCHEMA), "1 day"), COMPUTE, order_col=None)
    q = (s.writeStream.format("memory").queryName("dedupe_any").outputMode("append")
         .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("select cluster_id from dedupe_any").collect()
    assert sorted(r.cluster_id for r in rows) == ["c1", "c2"]


def test_state_partitions_follow_cluster_parallelism_not_batch_setting(spark):
    from headroom.session import fresh_path
    from headroom.streaming.landing import compute_daily_stream, start_with_state_partitions

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        base = fresh_path(spark, "state-parts")
        writer = (compute_daily_stream(spark, SF).writeStream.format("noop").outputMode("append")
                  .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True))
        q = start_with_state_partitions(spark, writer, 3)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "37"  # session value restored
        q.awaitTermination()
        parts = {op["numShufflePartitions"] for p in q.recentProgress for op in p["stateOperators"]}
        assert parts == {3}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
