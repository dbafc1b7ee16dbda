"""Metric tables derived from the benchmark tables.

Each adapter is a projection (plus one lookup join for network) with a ``seq`` column that
gives the input order used by first-wins de-duplication. The derivations are deterministic
so the same tables can be rebuilt in SQL for cross-checking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.functions.numeric import packed_order
from headroom.functions.timeutil import floor_hour_ntz

# The resources are the real users, suppliers and customers; SHAPES only varies the course of their values.
SHAPES = 5

# Storage derivation over the whole lineitem table: a base level and a growth per shape
# (fractions of capacity, the growth spread over STORAGE_SPAN_DAYS days from STORAGE_START);
# the shapes end near different thresholds so every storage rule outcome occurs.
STORAGE_START = "1995-01-01"
STORAGE_SPAN_DAYS = 2500
STORAGE_BASE = (0.46, 0.11, 0.30, 0.215, 0.49)
STORAGE_SLOPE = (0.50, 0.75, 0.05, 0.50, 0.30)
STORAGE_TOTAL_GB = 1000.0
# A link carries the orders of CUSTOMERS_PER_LINK customers; order totals are scaled to the bandwidth.
CUSTOMERS_PER_LINK = 10
NETWORK_BANDWIDTH_MBPS = 500.0
ORDER_TOTAL_PER_MBPS = 977.0
# Not a round number, so means and fits seldom end in a rounding tie.
EVENT_VALUE_PER_PCT = 0.977


# Columns of the benchmark tables the adapters read (explicit schemas: no footer inference,
# and a file with a different type fails loudly instead of being coerced).
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SOURCE_SCHEMAS[name]) if name in SOURCE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _by_shape(k: Column, values) -> Column:
    out = None
    for i, v in enumerate(values):
        out = (F.when(k == i, v) if out is None else out.when(k == i, v))
    return out


def _id(prefix: str, k: Column) -> Column:
    return F.concat(F.lit(prefix), k.cast("string"))


def compute_from_events(events: DataFrame) -> DataFrame:
    """Hourly cluster utilisation: cluster = user_id, cpu a function of value and the cluster's shape."""
    k = F.col("user_id") % SHAPES
    v = F.col("value") / EVENT_VALUE_PER_PCT
    cpu = _by_shape(k, [v * 0.2, v * 0.4, F.lit(40.0) + v * 0.2, F.lit(85.0) + v * 0.2, v * 3.0 - F.lit(20.0)])
    return events.select(
        floor_hour_ntz("ts").alias("timestamp"), _id("cluster-", F.col("user_id")).alias("cluster_id"),
        cpu.alias("cpu_utilization_pct"), (cpu * 0.9).alias("memory_utilization_pct"),
        cpu.alias("cluster_utilization_pct"), F.col("event_id").alias("seq"))


def storage_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Daily disk usage: storage = l_suppkey, used = capacity * (base + slope * day / span) + quantity."""
    li = lineitem
    k = F.col("l_suppkey") % SHAPES
    d = F.datediff(F.to_date("l_shipdate"), F.lit(STORAGE_START).cast("date"))
    level = _by_shape(k, [F.lit(b) for b in STORAGE_BASE]) + _by_shape(k, [F.lit(s) for s in STORAGE_SLOPE]) * d / STORAGE_SPAN_DAYS
    used = F.lit(STORAGE_TOTAL_GB) * level + F.col("l_quantity")
    total = F.lit(STORAGE_TOTAL_GB)
    return li.select(
        F.col("l_shipdate").alias("timestamp"), _id("storage-", F.col("l_suppkey")).alias("storage_id"),
        used.alias("disk_used_gb"), total.alias("disk_total_gb"), (used / total * 100.0).alias("disk_utilization_pct"),
        (F.col("l_discount") * 1000.0 + F.col("l_tax") * 500.0).alias("io_utilization_pct"),
        # By order, line, part, quantity and price (in cents); the supplier is the same within a key.
        packed_order(("l_orderkey", 12), ("l_linenumber", 1), ("l_partkey", 11), (F.rint(F.col("l_quantity") * 100), 4),
                     (F.rint(F.col("l_extendedprice") * 100), 10)).alias("seq"))


def network_from_orders(orders: DataFrame, customer: DataFrame, dedupe_before_lookup: bool = False) -> DataFrame:
    """Daily link load: link = ten customers, throughput = order total, latency = customer balance.

    A left lookup join on the unique customer key, so every order keeps exactly one row.
    Because the lookup neither adds nor drops orders, first-wins de-duplication commutes with
    it: ``dedupe_before_lookup`` reduces the orders to one row per (day, link) first, so the
    join sees a table of days x links instead of every order (same cleaned result).
    """
    o = orders.select(
        F.col("o_orderdate").alias("timestamp"), _id("link-", F.floor(F.col("o_custkey") / CUSTOMERS_PER_LINK)).alias("link_id"),
        F.lit(NETWORK_BANDWIDTH_MBPS).alias("bandwidth_mbps"), (F.col("o_totalprice") / ORDER_TOTAL_PER_MBPS).alias("throughput_mbps"),
        F.col("o_custkey").alias("_custkey"), F.col("o_orderkey").alias("seq"))
    if dedupe_before_lookup:
        from headroom.operators.cleaning import dedupe_first
        o = dedupe_first(o, ("timestamp", "link_id"))
    c = customer.select(F.col("c_custkey"), F.col("c_acctbal"))
    j = o.join(c, o["_custkey"] == c["c_custkey"], "left")
    return j.select("timestamp", "link_id", "bandwidth_mbps", "throughput_mbps",
                    F.col("c_acctbal").alias("latency_ms"), "seq")


def raw_compute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compute_from_events(_table(spark, sf_dir, "events"))


def raw_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage_from_lineitem(_table(spark, sf_dir, "lineitem"))


def raw_network(spark: SparkSession, sf_dir: str, dedupe_before_lookup: bool = False) -> DataFrame:
    return network_from_orders(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer"),
                               dedupe_before_lookup)


def raw_all(spark: SparkSession, sf_dir: str, dedupe_before_lookup: bool = False) -> dict[str, DataFrame]:
    return {"compute": raw_compute(spark, sf_dir), "storage": raw_storage(spark, sf_dir),
            "network": raw_network(spark, sf_dir, dedupe_before_lookup)}
