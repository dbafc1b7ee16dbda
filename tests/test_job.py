import glob
import os
import re
import tempfile

import numpy as np
import pyarrow.parquet as pq

from headroom.operators.forecast import forecast_all
from headroom.plans.capacity_job import read_export, run_job
from tests.conftest import day, hour
from tests.frames import compute_df, network_df, storage_df
from tests.test_plans import plan


def test_job_end_to_end_small(spark):
    n_days = 45
    compute = compute_df(spark, [(hour(h), f"cluster-{c}", 20.0 + 30 * c + (h % 24), 40.0, 20.0 + 30 * c + (h % 24))
                                 for c in range(2) for h in range(n_days * 24)])
    storage = storage_df(spark, [(day(i), f"storage-{s}", 500.0 + s * 300 + 4 * i, 1000.0, None, 30.0)
                                 for s in range(2) for i in range(n_days)])
    network = network_df(spark, [(hour(h), f"link-{k}", 1000.0, float(200.0 + 100 * np.sin(h / 24)), 20.0)
                                 for k in range(2) for h in range(n_days * 24)])
    out = tempfile.mkdtemp(prefix="headroom-job-")
    raw = {"compute": compute, "storage": storage, "network": network}
    log = run_job(spark, raw, out)
    assert all(log[k] > 0 for k in ("compute_cleaned", "storage_trends", "forecasts", "recommendations",
                                    "utilization_overview", "risk_summary"))
    assert (log["series_compute"], log["series_storage"], log["series_network"]) == (2, 2, 2)
    assert log["critical"] >= 1
    for p in ("export/utilization_overview", "export/recommendations", "export/risk_summary",
              "processed/recommendations_csv"):
        assert os.path.isdir(os.path.join(out, p))
    fc = spark.read.parquet(os.path.join(out, "processed/forecasts"))
    assert {r.model for r in fc.select("model").distinct().collect()} == {"linear_regression", "seasonal"}
    recs = spark.read.parquet(os.path.join(out, "processed/recommendations"))
    assert recs.where("ai_narrative is null").count() == 0
    assert {r.resource_type for r in recs.select("resource_type").distinct().collect()} == {"compute", "storage", "network"}
    # storage-1 grows 4 GB/day from 800 of 1000: past 90 % within 4 weeks -> critical
    s1 = recs.where("resource_id = 'storage-1'").collect()
    assert [(r.risk_level, r.forecast_horizon_weeks) for r in s1] == [("critical", 4)]

    # a re-run with resume reuses every finished stage table
    again = run_job(spark, raw, out, resume=True)
    assert again["compute_cleaned"] == -1 and again["forecasts"] == -1 and again["recommendations"] == -1
    # with other horizons the forecasts and what follows are made again
    other = run_job(spark, raw, out, horizons_weeks=[4, 12, 2], resume=True)
    assert other["compute_cleaned"] == -1 and other["forecasts"] > 0 and other["recommendations"] > 0
    fc = spark.read.parquet(os.path.join(out, "processed/forecasts"))
    assert {r.horizon_weeks for r in fc.select("horizon_weeks").distinct().collect()} == {2, 4, 12}


def test_job_from_raw_csv_dir(spark):
    from headroom.plans.capacity_job import run_from_raw_dir

    base = tempfile.mkdtemp(prefix="headroom-rawjob-")
    raw = os.path.join(base, "raw")
    os.makedirs(raw)
    lines = {"compute_metrics": ["timestamp,cluster_id,cpu_utilization_pct,memory_utilization_pct,cluster_utilization_pct"],
             "storage_metrics": ["timestamp,storage_id,disk_used_gb,disk_total_gb,disk_utilization_pct,io_utilization_pct"],
             "network_metrics": ["timestamp,link_id,bandwidth_mbps,throughput_mbps,latency_ms"]}
    for i in range(40):
        ts = f"2025-01-{1 + i % 31:02d} 00:00:00" if i < 31 else f"2025-02-{i - 30:02d} 00:00:00"
        lines["compute_metrics"].append(f"{ts},c1,{20 + i % 3},30,{20 + i % 3}")
        lines["storage_metrics"].append(f"{ts},s1,{600 + 5 * i},1000,0,40")
        lines["network_metrics"].append(f"{ts},n1,1000,{300 + (i % 7) * 10},25")
    for name, ls in lines.items():
        with open(os.path.join(raw, f"{name}.csv"), "w") as f:
            f.write("\n".join(ls) + "\n")
    out = os.path.join(base, "out")
    log = run_from_raw_dir(spark, raw, out)
    assert log["compute_ingested"] == 40 and log["recommendations"] > 0
    recs = {r.resource_id: r for r in spark.read.parquet(os.path.join(out, "processed/recommendations")).collect()}
    assert recs["c1"].recommendation_type == "downsize_underutilized_compute"


def test_job_from_raw_dir_fails_on_broken_rule_after_one_pass(spark):
    import pytest

    from headroom.operators.quality import SchemaValidationError
    from headroom.plans.capacity_job import run_from_raw_dir

    base = tempfile.mkdtemp(prefix="headroom-rawfail-")
    raw = os.path.join(base, "raw")
    os.makedirs(raw)
    files = {"compute_metrics": "timestamp,cluster_id,cpu_utilization_pct,memory_utilization_pct,cluster_utilization_pct\n"
                                "2025-01-01 00:00:00,c1,150,30,20\n",
             "storage_metrics": "timestamp,storage_id,disk_used_gb,disk_total_gb,disk_utilization_pct,io_utilization_pct\n"
                                "2025-01-01 00:00:00,s1,10,100,10,5\n",
             "network_metrics": "timestamp,link_id,bandwidth_mbps,throughput_mbps,latency_ms\n"
                                "2025-01-01 00:00:00,n1,1000,10,5\n"}
    for name, text in files.items():
        with open(os.path.join(raw, f"{name}.csv"), "w") as f:
            f.write(text)
    with pytest.raises(SchemaValidationError, match="cpu_utilization_pct out of bounds"):
        run_from_raw_dir(spark, raw, os.path.join(base, "out"))
    log = run_from_raw_dir(spark, raw, os.path.join(base, "out2"), on_violation="report")
    assert log["compute_cpu_out_of_bounds"] == 1 and log["compute_ingested"] == 1


def test_steps_run_together_and_log_in_order(spark):
    import threading

    import pytest
    from headroom.plans.capacity_job import _together
    both = threading.Barrier(2, timeout=60)  # passed only if both steps run at once

    def step(name):
        def run(own):
            both.wait()
            own[name] = spark.range(3).count()
            if name == "bad":
                raise ValueError(name)
            return name
        return run

    log = {"before": 1}
    assert _together(spark, log, step("b"), step("a")) == ["b", "a"] and list(log) == ["before", "b", "a"]
    with pytest.raises(ValueError, match="bad"):
        _together(spark, log, step("bad"), step("c"))
    assert log["c"] == 3


def _shuffle_files(spark) -> set[str]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_job_leaves_no_shuffle_files_and_small_tables(spark):
    """The job's disk: each stage's shuffle goes with the stage, tables and the long export are compressed."""
    compute = compute_df(spark, [(hour(h), f"cluster-{c}", 20.0 + c + h % 24, 40.0, 20.0 + c + h % 24) for c in range(3) for h in range(40 * 24)])
    storage = storage_df(spark, [(day(i), f"storage-{s}", 500.0 + 4 * i, 1000.0, None, 30.0) for s in range(3) for i in range(40)])
    network = network_df(spark, [(hour(h), f"link-{k}", 1000.0, 200.0 + h % 7, 20.0) for k in range(3) for h in range(40 * 24)])
    out, key = tempfile.mkdtemp(prefix="headroom-job-"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(key)
    run_job(spark, {"compute": compute, "storage": storage, "network": network}, out)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(key) == was
    for t in ("compute_cleaned", "storage_trends", "series", "forecasts", "recommendations"):
        codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in glob.glob(f"{out}/processed/{t}/*.parquet")
                  if pq.ParquetFile(f).metadata.num_rows}
        assert codecs == {"ZSTD"}, t
    assert not glob.glob(f"{out}/export/utilization_overview/*.csv")
    overview = read_export(spark, out, "utilization_overview", "resource_id string, resource_type string, date date, utilization_pct double")
    assert overview.count() == 9 * 40 and overview.where("utilization_pct is null").count() == 0


def test_forecasts_of_a_written_series_shuffle_its_rows_once(spark):
    path = f"{tempfile.mkdtemp(prefix='headroom-series-')}/series"
    spark.createDataFrame([("compute", f"c{c}", day(i).date(), float(i % 7), i) for c in range(4) for i in range(30)],
                          "resource_type string, resource_id string, ds date, y double, t long").write.parquet(path)
    found = plan(forecast_all(spark.read.parquet(path), [4], spread=6)).split("\n\n")[0]
    assert len(re.findall(r"(?<!\w)Exchange", found)) == 1, found
