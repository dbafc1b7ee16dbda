from pyspark.sql import functions as F

from headroom.operators.export import risk_summary, utilization_overview
from tests.conftest import d


def test_export_trio(spark):
    trends = {
        "compute": spark.createDataFrame([("c1", d(i), 40.0 + i) for i in range(3)],
                                         "cluster_id string, date date, cluster_utilization_pct double"),
        "storage": spark.createDataFrame([("s1", d(i), 60.123456 + i) for i in range(3)],
                                         "storage_id string, date date, disk_utilization_pct double"),
        "network": spark.createDataFrame([("n1", d(i), 1000.0, 300.0 + 20 * i) for i in range(3)],
                                         "link_id string, date date, bandwidth_mbps double, throughput_mbps double"),
    }
    o = utilization_overview(trends)
    assert o.columns == ["resource_id", "resource_type", "date", "utilization_pct"] and o.count() == 9
    net = [r.utilization_pct for r in o.where(F.col("resource_type") == "network").orderBy("date").collect()]
    assert net == [30.0, 32.0, 34.0]
    st = o.where(F.col("resource_type") == "storage").orderBy("date").first()
    assert st.utilization_pct == 60.123456  # storage passes through unrounded


def test_risk_summary(spark):
    recs = spark.createDataFrame([("storage", "critical"), ("storage", "warning"), ("compute", "warning"),
                                  ("compute", "warning")], "resource_type string, risk_level string")
    got = {(r.resource_type, r.risk_level): r["count"] for r in risk_summary(recs).collect()}
    assert got == {("storage", "critical"): 1, ("storage", "warning"): 1, ("compute", "warning"): 2}


def test_risk_summary_empty(spark):
    empty = spark.createDataFrame([], "resource_type string, risk_level string")
    out = risk_summary(empty)
    assert out.columns == ["resource_type", "risk_level", "count"] and out.count() == 0
