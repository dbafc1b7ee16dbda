import os
import tempfile

import pytest

from headroom.operators.quality import SchemaValidationError
from headroom.sources.files import read_all, read_metrics, write_table, land_recommendations


def _tmp():
    return tempfile.mkdtemp(prefix="headroom-test-")


def test_sink_round_trip_nested_path(spark):
    base = _tmp()
    df = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    path, rows = write_table(df, os.path.join(base, "x", "y", "z"), "csv")
    assert rows == 3 and path.endswith("z")
    back = spark.read.option("header", True).csv(path)
    assert sorted(int(r.a) for r in back.collect()) == [1, 2, 3]


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_read_metrics_csv_nan_seq_and_validation(spark):
    base = _tmp()
    p = os.path.join(base, "compute_metrics.csv")
    _write(p, "timestamp,cluster_id,cpu_utilization_pct,memory_utilization_pct,cluster_utilization_pct,extra\n"
              "2025-01-01 00:00:00,c1,50,40,NaN,x\n2025-01-01 01:00:00,c1,,41,45,y\n")
    df = read_metrics(spark, p, "compute")
    rows = df.orderBy("seq").collect()
    assert rows[0].cluster_utilization_pct is None and rows[1].cpu_utilization_pct is None
    assert rows[0].seq < rows[1].seq
    assert str(rows[0].timestamp) == "2025-01-01 00:00:00"


def test_read_metrics_fail_and_report(spark):
    base = _tmp()
    p = os.path.join(base, "network_metrics.csv")
    _write(p, "timestamp,link_id,bandwidth_mbps,throughput_mbps,latency_ms\n2025-01-01 00:00:00,n1,1000,500,-5\n")
    with pytest.raises(SchemaValidationError, match="latency_ms cannot be negative"):
        read_metrics(spark, p, "network")
    assert read_metrics(spark, p, "network", on_violation="report").count() == 1


def test_read_all_parquet(spark):
    base = _tmp()
    from headroom.schemas import KINDS
    for kind, name in (("compute", "compute_metrics"), ("storage", "storage_metrics"), ("network", "network_metrics")):
        spark.createDataFrame([], KINDS[kind].schema).write.parquet(os.path.join(base, f"{name}.parquet"))
    out = read_all(spark, base, fmt="parquet")
    assert set(out) == {"compute", "storage", "network"} and all(df.count() == 0 for df in out.values())


def test_land_recommendations_json_details(spark):
    base = _tmp()
    recs = spark.createDataFrame([("s", {"threshold": 90.0})], "resource_id string, details map<string,double>")
    path, rows = land_recommendations(recs, os.path.join(base, "recs"))
    back = spark.read.option("header", True).option("escape", '"').csv(path).first()
    assert rows == 1 and back.details == '{"threshold":90.0}'


def test_file_stage_chain_csv_to_series(spark):
    """S2 read_all -> S3 write_interim -> S4 clean_all -> S6 write_trends -> S7 load_series."""
    from headroom.sources.files import clean_all, load_series, write_interim, write_trends
    base = _tmp()
    raw = os.path.join(base, "raw")
    os.makedirs(raw)
    hdr = {"compute_metrics": "timestamp,cluster_id,cpu_utilization_pct,memory_utilization_pct,cluster_utilization_pct",
           "storage_metrics": "timestamp,storage_id,disk_used_gb,disk_total_gb,disk_utilization_pct,io_utilization_pct",
           "network_metrics": "timestamp,link_id,bandwidth_mbps,throughput_mbps,latency_ms"}
    rows = {"compute_metrics": ["2025-01-0{d} 0{h}:00:00,c1,{v},40,{v}"],
            "storage_metrics": ["2025-01-0{d} 00:00:00,s1,{v}0,1000,1,120"],
            "network_metrics": ["2025-01-0{d} 0{h}:00:00,n1,1000,{v}0,20"]}
    for name, h in hdr.items():
        lines = [h] + [rows[name][0].format(d=dd, h=hh, v=10 + dd * 5 + hh) for dd in (1, 2, 3) for hh in (0, 1)]
        lines.append(lines[1])  # an exact duplicate of the first row
        _write(os.path.join(raw, f"{name}.csv"), "\n".join(lines) + "\n")
    ingested = read_all(spark, raw)
    logs = write_interim(ingested, os.path.join(base, "interim"))
    assert {k: v[1] for k, v in logs.items()} == {"compute": 7, "storage": 7, "network": 7}
    cleaned = clean_all(spark, os.path.join(base, "interim"), os.path.join(base, "processed"))
    assert cleaned["compute"].count() == 6 and cleaned["storage"].count() == 3  # storage is daily: 1 row per day
    assert {r.io_utilization_pct for r in cleaned["storage"].collect()} == {100.0}
    trends = write_trends(spark, os.path.join(base, "processed"))
    assert trends["network"].count() == 3
    s = load_series(spark, os.path.join(base, "processed"))
    got = {(r.resource_type, r.resource_id): r["count"] for r in s.groupBy("resource_type", "resource_id").count().collect()}
    assert got == {("compute", "c1"): 3, ("storage", "s1"): 3, ("network", "n1"): 3}


def test_write_table_logs_label_rows_and_path(spark, caplog):
    import logging
    base = _tmp()
    out = os.path.join(base, "deep", "nested", "t")
    with caplog.at_level(logging.INFO, logger="headroom.sources.files"):
        path, rows = write_table(spark.createDataFrame([(1,), (2,), (3,)], "a int"), out, "csv", label="Test data")
    assert os.path.exists(out) and path == out and rows == 3
    assert "[SAVED]" in caplog.text and "Test data" in caplog.text and "3 rows" in caplog.text and out in caplog.text


def test_read_metrics_accepts_pandas_and_spark_timestamp_text(spark):
    base = _tmp()
    p = os.path.join(base, "compute_metrics.csv")
    _write(p, "timestamp,cluster_id,cpu_utilization_pct,memory_utilization_pct,cluster_utilization_pct\n"
              "2025-01-01 00:00:00,c1,1,1,1\n2025-01-01T01:00:00.000,c1,2,2,2\n2025-01-02,c1,3,3,3\n")
    rows = read_metrics(spark, p, "compute").orderBy("timestamp").collect()
    assert [str(r.timestamp) for r in rows] == ["2025-01-01 00:00:00", "2025-01-01 01:00:00", "2025-01-02 00:00:00"]


def test_spark_written_csv_round_trips_through_the_cleaners(spark):
    from headroom.operators.cleaning import clean_compute
    from tests.conftest import hour
    from tests.frames import compute_df
    base = _tmp()
    src = compute_df(spark, [(hour(i), "c1", float(i), 1.0, 1.0) for i in range(30)]).drop("seq")
    write_table(src, os.path.join(base, "compute_metrics.csv"), "csv")
    back = read_metrics(spark, os.path.join(base, "compute_metrics.csv"), "compute")
    assert clean_compute(back).count() == 30


def test_file_input_first_wins_in_file_order(spark):
    from headroom.operators.cleaning import clean_compute
    base = _tmp()
    p = os.path.join(base, "compute_metrics.csv")
    lines = ["timestamp,cluster_id,cpu_utilization_pct,memory_utilization_pct,cluster_utilization_pct"]
    lines += [f"2025-01-01 00:00:00,c1,{v},1,1" for v in (70, 10, 40)]  # same key three times
    lines += [f"2025-01-01 0{h}:00:00,c2,{h},1,1" for h in range(1, 9)]
    _write(p, "\n".join(lines) + "\n")
    out = {(r.cluster_id, str(r.timestamp)): r.cpu_utilization_pct for r in clean_compute(read_metrics(spark, p, "compute")).collect()}
    assert out[("c1", "2025-01-01 00:00:00")] == 70.0 and len(out) == 9
