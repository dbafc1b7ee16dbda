import pytest

from headroom.operators.quality import SchemaValidationError, check_metrics, require_columns, violation_counts
from tests.conftest import hour
from tests.frames import compute_df, network_df, storage_df


def test_missing_columns_message(spark):
    df = compute_df(spark, [(hour(0), "c1", 50.0, 40.0, 45.0)]).drop("cpu_utilization_pct")
    with pytest.raises(SchemaValidationError, match=r"compute metrics is missing required columns: \['cpu_utilization_pct'\]"):
        check_metrics(df, "compute")


def test_extra_columns_and_order_are_fine(spark):
    df = compute_df(spark, [(hour(0), "c1", 50.0, 40.0, 45.0)]).select("cluster_id", "seq", "timestamp",
                                                                        "memory_utilization_pct",
                                                                        "cluster_utilization_pct",
                                                                        "cpu_utilization_pct")
    require_columns(df, ["timestamp", "cluster_id"], "x")
    assert check_metrics(df, "compute") is df


def test_cpu_out_of_bounds(spark):
    df = compute_df(spark, [(hour(0), "c1", 150.0, 40.0, 45.0)])
    with pytest.raises(SchemaValidationError, match=r"cpu_utilization_pct out of bounds"):
        check_metrics(df, "compute")


def test_cpu_bounds_inclusive_and_missing_passes(spark):
    df = compute_df(spark, [(hour(0), "c1", 0.0, 40.0, 45.0), (hour(1), "c1", 100.0, 40.0, 45.0),
                            (hour(2), "c1", None, 40.0, 45.0)])
    check_metrics(df, "compute")


def test_used_exceeds_total(spark):
    df = storage_df(spark, [(hour(0), "s1", 1200.0, 1000.0, 120.0, 50.0)])
    with pytest.raises(SchemaValidationError, match="disk_used_gb cannot exceed disk_total_gb"):
        check_metrics(df, "storage")
    check_metrics(storage_df(spark, [(hour(0), "s1", 1000.0, 1000.0, 100.0, 50.0)]), "storage")


def test_negative_latency(spark):
    df = network_df(spark, [(hour(0), "n1", 1000.0, 500.0, -5.0)])
    with pytest.raises(SchemaValidationError, match="latency_ms cannot be negative"):
        check_metrics(df, "network")


def test_violation_counts(spark):
    df = compute_df(spark, [(hour(0), "c1", -1.0, 1.0, 1.0), (hour(1), "c1", 101.0, 1.0, 1.0),
                            (hour(2), "c1", 50.0, 1.0, 1.0), (hour(3), "c1", None, 1.0, 1.0)])
    row = violation_counts(df, "compute").collect()
    assert [(r.table_name, r.rule, r.violations) for r in row] == [("compute", "cpu_out_of_bounds", 2)]


def test_observed_checks_run_in_the_consuming_job(spark):
    from headroom.operators.quality import observe_quality, raise_on_violations
    df = network_df(spark, [(hour(0), "n1", 1000.0, 500.0, -5.0), (hour(1), "n1", 1000.0, 500.0, 5.0)])
    observed, obs = observe_quality(df, "network")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"negative_latency": 1, "missing_timestamp": 0}
    with pytest.raises(SchemaValidationError, match="latency_ms cannot be negative"):
        raise_on_violations(obs, "network")
