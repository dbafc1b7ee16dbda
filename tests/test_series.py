import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.operators.series import prepare_all, prepare_series, resource_counts, time_spine
from tests.conftest import d


def test_two_series_t_index(spark):
    df = spark.createDataFrame([("c1", d(0), 40.0), ("c1", d(1), 45.0), ("c2", d(0), 60.0), ("c2", d(1), 62.0)],
                               "cluster_id string, date date, cluster_utilization_pct double")
    out = prepare_series(df, "cluster_id", "date", "cluster_utilization_pct", "compute")
    assert set(out.columns) == {"resource_type", "resource_id", "ds", "y", "t"}
    rows = out.orderBy("resource_id", "ds").collect()
    assert [(r.resource_id, r.t, r.y) for r in rows] == [("c1", 0, 40.0), ("c1", 1, 45.0), ("c2", 0, 60.0), ("c2", 1, 62.0)]


def test_gap_does_not_advance_t_and_null_id_dropped(spark):
    df = spark.createDataFrame([("c1", d(0), 1.0), ("c1", d(1), 2.0), ("c1", d(9), 3.0), (None, d(0), 9.0)],
                               "cluster_id string, date date, cluster_utilization_pct double")
    rows = prepare_series(df, "cluster_id", "date", "cluster_utilization_pct", "compute").orderBy("ds").collect()
    assert [r.t for r in rows] == [0, 1, 2]


def test_prepare_all_three_types(spark):
    mk = lambda idc, col, vals: spark.createDataFrame(
        [("r1", d(i), v) for i, v in enumerate(vals)], f"{idc} string, date date, {col} double")
    trends = {"compute": mk("cluster_id", "cluster_utilization_pct", [40.0, 42.0, 44.0]),
              "storage": mk("storage_id", "disk_utilization_pct", [60.0, 62.0, 64.0]),
              "network": mk("link_id", "throughput_mbps", [300.0, 310.0, 320.0])}
    s = prepare_all(trends)
    assert {r.resource_type for r in s.select("resource_type").distinct().collect()} == {"compute", "storage", "network"}
    assert [r.y for r in s.where(F.col("resource_type") == "storage").orderBy("t").collect()] == [60.0, 62.0, 64.0]
    assert {(r.resource_type, r.n_resources) for r in resource_counts(s).collect()} == \
        {("compute", 1), ("storage", 1), ("network", 1)}


def test_time_spine(spark):
    df = spark.createDataFrame([(d(0),)], T.StructType([T.StructField("s", T.DateType())]))
    days = df.select(F.explode(time_spine("s", 3)).alias("x")).collect()
    assert [r.x for r in days] == [d(0), d(1), d(2)]
    hours = df.select(F.explode(time_spine(F.col("s").cast("timestamp_ntz"), 3, "hour")).alias("x")).collect()
    assert [r.x.hour for r in hours] == [0, 1, 2]
    assert df.select(F.size(time_spine("s", 0)).alias("n")).first().n == 0


def test_missing_days(spark):
    from headroom.operators.series import missing_days, time_spine
    rows = [("compute", "a", d(0), 1.0, 0), ("compute", "a", d(3), 1.0, 1), ("compute", "a", d(4), None, 2), ("compute", "b", d(9), 1.0, 0)]
    s = spark.createDataFrame(rows, "resource_type string, resource_id string, ds date, y double, t long")
    assert sorted(map(tuple, missing_days(s).collect())) == [("compute", "a", d(1)), ("compute", "a", d(2))]
    with pytest.raises(ValueError):
        time_spine("ds", F.lit(3), "hour")


def test_missing_days_makes_no_day_that_has_a_row(spark):
    """Only gaps are made, in the pass that orders the resource: no spine over all its days joined with its rows."""
    import contextlib
    import io
    from headroom.operators.series import missing_days
    rows = [("compute", "a", d(i), 1.0, i) for i in range(0, 60) if i % 20] + [("storage", "a", d(0), 1.0, 0), ("storage", "a", d(400), 1.0, 1), ("network", "c", d(5), 1.0, 0)]
    s = spark.createDataFrame(rows, "resource_type string, resource_id string, ds date, y double, t long")
    out = missing_days(s)
    want = [("compute", "a", d(i)) for i in (20, 40)] + [("storage", "a", d(i)) for i in range(1, 400)]
    assert sorted(map(tuple, out.collect())) == want
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain()
    assert "Join" not in text.getvalue()
