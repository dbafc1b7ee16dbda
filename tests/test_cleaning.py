import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.operators.cleaning import clean_compute, clean_network, clean_storage, dedupe_first
from tests.conftest import day, hour
from tests.frames import compute_df, network_df, storage_df


def test_dirty_compute(spark):
    df = compute_df(spark, [
        (day(0), "c1", 50.0, 40.0, 45.0), (day(0), "c1", 50.0, 40.0, 45.0),
        (day(1), "c1", 120.0, 60.0, 90.0), (day(2), "c1", None, 70.0, 75.0)])
    out = clean_compute(df).orderBy("timestamp").collect()
    assert len(out) == 2
    assert [r.cpu_utilization_pct for r in out] == [50.0, 100.0]
    assert all(0 <= r.cpu_utilization_pct <= 100 for r in out)


def test_dirty_storage(spark):
    df = storage_df(spark, [(day(0), "s1", 600.0, 1000.0, 1.0, 50.0), (day(1), "s1", 1100.0, 1000.0, 1.0, 150.0)])
    out = clean_storage(df).collect()
    assert len(out) == 1
    assert out[0].disk_utilization_pct == 60.0  # recomputed, incoming value ignored
    assert out[0].io_utilization_pct == 50.0


def test_dirty_network(spark):
    df = network_df(spark, [(day(0), "n1", 1000.0, 500.0, 20.0), (day(1), "n1", 1000.0, -10.0, -5.0)])
    out = clean_network(df).collect()
    assert len(out) == 1 and out[0].throughput_mbps == 500.0


def test_network_negative_throughput_clipped_and_zero_latency_kept(spark):
    df = network_df(spark, [(day(0), "n1", 1000.0, -10.0, 0.0)])
    out = clean_network(df).collect()
    assert len(out) == 1 and out[0].throughput_mbps == 0.0


def test_first_copy_missing_evicts_valid_later_copy(spark):
    df = compute_df(spark, [(hour(0), "c1", None, 40.0, 45.0), (hour(0), "c1", 50.0, 40.0, 45.0),
                            (hour(1), "c1", 10.0, 40.0, 45.0)])
    out = clean_compute(df).collect()
    assert [r.cpu_utilization_pct for r in out] == [10.0]


def test_dedupe_keeps_smallest_seq_not_arbitrary(spark):
    rows = [(hour(0), "c1", float(v), 1.0, 1.0) for v in range(50)]
    df = compute_df(spark, rows).repartition(7)
    out = dedupe_first(df, ["timestamp", "cluster_id"]).collect()
    assert len(out) == 1 and out[0].cpu_utilization_pct == 0.0 and out[0].seq == 0


def test_dedupe_null_keys_form_one_group(spark):
    df = compute_df(spark, [(None, "c1", 1.0, 1.0, 1.0), (None, "c1", 2.0, 1.0, 1.0)])
    out = dedupe_first(df, ["timestamp", "cluster_id"]).collect()
    assert len(out) == 1 and out[0].cpu_utilization_pct == 1.0


def test_dedupe_composite_order(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType()),
                           T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    df = spark.createDataFrame([("x", 1.0, 2, 1), ("x", 2.0, 1, 9), ("x", 3.0, 1, 5)], schema)
    df = df.withColumn("seq", F.struct("a", "b")).drop("a", "b")
    out = dedupe_first(df, ["k"]).collect()
    assert out[0].v == 3.0


def test_optional_column_missing_stays_missing(spark):
    df = compute_df(spark, [(hour(0), "c1", 50.0, 40.0, None)])
    out = clean_compute(df).collect()
    assert out[0].cluster_utilization_pct is None
    st = storage_df(spark, [(hour(0), "s1", 10.0, 100.0, None, None)])
    assert clean_storage(st).collect()[0].io_utilization_pct is None


def test_nan_is_treated_as_missing_after_normalisation(spark):
    from headroom.sources.files import normalise_missing
    df = normalise_missing(compute_df(spark, [(hour(0), "c1", float("nan"), 40.0, float("nan"))]))
    assert clean_compute(df).count() == 0


def test_zero_total_with_zero_used_gives_missing_pct(spark):
    df = storage_df(spark, [(day(0), "s1", 0.0, 0.0, None, 10.0)])
    out = clean_storage(df).collect()
    assert len(out) == 1 and out[0].disk_utilization_pct is None


def test_disk_pct_rounding_matches_numpy(spark):
    import numpy as np
    used = [333.333, 1.005, 2.675, 999.995, 123.4549]
    df = storage_df(spark, [(day(i), "s1", u, 1000.0, None, 1.0) for i, u in enumerate(used)])
    got = [r.disk_utilization_pct for r in clean_storage(df).orderBy("timestamp").collect()]
    want = list(np.round(np.array(used) / 1000.0 * 100, 2))
    assert got == want


def test_sort_series_orders_by_id_then_time_with_missing_last(spark):
    from headroom.operators.cleaning import sort_series
    df = compute_df(spark, [(hour(3), "b", 1.0, 1.0, 1.0), (hour(1), None, 1.0, 1.0, 1.0), (hour(2), "a", 1.0, 1.0, 1.0),
                            (None, "a", 1.0, 1.0, 1.0), (hour(0), "b", 1.0, 1.0, 1.0)])
    rows = [(r.cluster_id, r.timestamp) for r in sort_series(df, "cluster_id", "timestamp").collect()]
    assert rows == [("a", hour(2)), ("a", None), ("b", hour(0)), ("b", hour(3)), (None, hour(1))]


def test_network_dedupe_before_lookup_gives_the_same_cleaned_rows(spark):
    from headroom.sources.adapters import network_from_orders
    orders = spark.createDataFrame(
        [(1, 10, "O", 100.0, day(0), "1-URGENT"), (2, 11, "O", 200.0, day(0), "1-URGENT"),
         (3, 99, "O", 300.0, day(0), "2-HIGH"), (4, 10, "O", 400.0, day(1), "1-URGENT")],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string")
    customer = spark.createDataFrame([(10, "a", 1, 5.0, "x"), (11, "b", 1, -3.0, "x")],
                                     "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    full = clean_network(network_from_orders(orders, customer))
    early = clean_network(network_from_orders(orders, customer, dedupe_before_lookup=True))
    assert sorted(full.collect()) == sorted(early.collect())
    assert {(r.link_id, r.seq) for r in full.collect()} == {("link-1", 1), ("link-1", 4)}  # order 3 has no customer


def test_hot_key_holding_a_third_of_rows(spark):
    """One (timestamp, id) group holds a third of all rows, spread over every input partition:
    partial aggregation collapses it per task; the survivor is still the smallest seq."""
    from pyspark.sql import functions as F

    from headroom.operators.trends import aggregate_daily
    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(dt.datetime(2025, 1, 1, 5)))
         .otherwise(F.make_timestamp_ntz(F.lit(2025), F.lit(1), (F.col("id") % 28 + 1).cast("int"),
                                         (F.col("id") % 24).cast("int"), F.lit(0), F.lit(0))).alias("timestamp"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string")))
         .alias("cluster_id"),
        (F.col("id") % 101).cast("double").alias("cpu_utilization_pct"),
        F.lit(1.0).alias("memory_utilization_pct"), F.lit(2.0).alias("cluster_utilization_pct"),
        (F.lit(n) - F.col("id")).alias("seq")).repartition(16)
    out = clean_compute(base)
    hot = out.where("cluster_id = 'hot'").collect()
    # hot rows are ids 0, 3, ..., 29997; the smallest seq = n - 29997 = 3 belongs to id 29997
    assert len(hot) == 1 and hot[0].seq == 3 and hot[0].cpu_utilization_pct == float(29997 % 101)
    daily = aggregate_daily(out, "cluster_id", ["cpu_utilization_pct"]).where("cluster_id = 'hot'").collect()
    assert len(daily) == 1
