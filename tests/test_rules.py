import numpy as np
import pytest

from headroom.operators import rules
from headroom.operators.cleaning import clean_compute, clean_network, clean_storage
from headroom.operators.forecast import forecast_linear
from headroom.operators.series import prepare_series
from headroom.operators.trends import process_compute_trends, process_network_trends, process_storage_trends
from tests.conftest import d, day, hour
from tests.frames import DAILY_COMPUTE, DAILY_NETWORK, compute_df, network_df, storage_df

PEAKS_SCHEMA = "resource_id string, peak_4 double, peak_12 double"


def _storage(spark, peaks):
    cur = spark.createDataFrame([(rid, 70.0) for rid, _, _ in peaks], "resource_id string, current_value double")
    p = spark.createDataFrame([x for x in peaks if x[1] is not None or x[2] is not None], PEAKS_SCHEMA)
    out = rules.rule_storage(cur, p).collect()
    res = {}
    for r in out:
        res.setdefault(r.resource_id, []).append(
            (r.risk_level, r.forecast_horizon_weeks, r.recommendation_type, dict(r.details)))
    return {k: sorted(v, key=lambda x: x[1]) for k, v in res.items()}


def test_storage_rule_branches(spark):
    got = _storage(spark, [("a", 80.0, 92.0), ("b", 80.0, 85.0), ("c", 50.0, 92.0), ("e", 50.0, 80.0),
                           ("f", 90.0, 99.0), ("g", 75.0, 75.0), ("h", 95.0, 97.0), ("i", 50.0, 55.0),
                           ("j", None, None), ("k", 80.0, None), ("l", None, 95.0)])
    lv = {k: [(x[0], x[1]) for x in v] for k, v in got.items()}
    assert lv["a"] == [("warning", 4), ("critical", 12)]
    assert lv["b"] == [("warning", 4), ("warning", 12)]
    assert lv["c"] == [("critical", 12)]
    assert lv["e"] == [("warning", 12)]
    assert lv["f"] == [("critical", 4)]
    assert lv["g"] == [("warning", 4), ("warning", 12)]
    assert lv["h"] == [("critical", 4)]
    assert lv["i"] == [("info", 0)] and got["i"][0][2] == "no_action" and got["i"][0][3] == {}
    assert lv["j"] == [("info", 0)]
    assert lv["k"] == [("warning", 4)]
    assert lv["l"] == [("critical", 12)]
    assert got["a"][1][3] == {"threshold": 90.0} and got["a"][0][3] == {"threshold": 75.0}


def test_storage_no_action_carries_current_value(spark):
    cur = spark.createDataFrame([("s", 42.5)], "resource_id string, current_value double")
    out = rules.rule_storage(cur, spark.createDataFrame([], PEAKS_SCHEMA)).first()
    assert (out.current_value, out.forecasted_value, out.forecast_horizon_weeks) == (42.5, 42.5, 0)


def _compute(spark, values):
    t = spark.createDataFrame([("c", d(i), v) for i, v in enumerate(values)], DAILY_COMPUTE)
    return rules.rule_compute(t).first()


def test_compute_rule_branches(spark):
    r = _compute(spark, [15.0] * 30)
    assert (r.recommendation_type, r.risk_level, dict(r.details)) == (
        "downsize_underutilized_compute", "warning", {"days_below_threshold": 30.0})
    assert _compute(spark, [14.9] * 30).recommendation_type == "decommission_orphaned_infrastructure"
    r = _compute(spark, [92.0] * 10)
    assert (r.recommendation_type, r.risk_level, dict(r.details)) == ("enable_temporary_autoscaling", "critical", {})
    assert _compute(spark, [85.0] * 10).recommendation_type == "enable_temporary_autoscaling"
    r = _compute(spark, [55.0] * 10)
    assert (r.recommendation_type, r.risk_level, r.current_value, r.forecasted_value) == ("no_action", "info", 55.0, 55.0)


def test_compute_chronic_threshold_and_precedence(spark):
    assert _compute(spark, [10.0] * 20 + [60.0] * 10).recommendation_type == "no_action"
    r = _compute(spark, [10.0] * 21 + [99.0] * 100)  # chronic first even when the mean is high
    assert r.recommendation_type == "downsize_underutilized_compute" and r.risk_level == "warning"
    assert _compute(spark, [29.9] * 21).details == {"days_below_threshold": 21.0}


def _network(spark, values, normalise_by="own_peak", bandwidth=100.0):
    t = spark.createDataFrame([("n", d(i), bandwidth, v, 10.0) for i, v in enumerate(values)], DAILY_NETWORK)
    return rules.rule_network(t, normalise_by=normalise_by).first()


def test_network_rule(spark):
    r = _network(spark, [20.0] * 20 + [90.0] * 5, "bandwidth")
    assert (r.recommendation_type, r.risk_level, dict(r.details)) == (
        "enable_temporary_autoscaling", "warning", {"spike_days": 5.0})
    assert r.forecasted_value == 90.0 and abs(r.current_value - 34.0) < 1e-12
    r = _network(spark, [30.0] * 20, "bandwidth")
    assert (r.recommendation_type, r.current_value, r.forecasted_value) == ("no_action", 30.0, 30.0)
    # own peak: a steady link is always at 100 % of its own peak
    r = _network(spark, [30.0] * 20)
    assert r.recommendation_type == "enable_temporary_autoscaling" and r.forecasted_value == 100.0
    assert _network(spark, [30.0]).recommendation_type == "no_action"  # one day < 2 spike days


def test_network_zero_peak_does_not_fail(spark):
    r = _network(spark, [0.0, 0.0, 0.0])
    assert r.recommendation_type == "no_action" and r.current_value is None
    r = _network(spark, [10.0, 10.0], "bandwidth", bandwidth=0.0)
    assert r.recommendation_type == "enable_temporary_autoscaling"  # inf >= 85


def test_bad_normalisation_rejected(spark):
    with pytest.raises(ValueError):
        _network(spark, [1.0], "median")


def test_risk_counts_and_latency_warning(spark):
    recs = spark.createDataFrame([("critical",), ("warning",), ("warning",), ("info",)], "risk_level string")
    r = rules.risk_counts(recs).first()
    assert (r.critical_count, r.warning_count) == (1, 2)
    t = spark.createDataFrame([("n", d(0), 1.0, 1.0, 150.0), ("n", d(1), 1.0, 1.0, 149.9)], DAILY_NETWORK)
    assert rules.latency_warning(t).first().latency_warning_days == 1


# ---- seeded scenarios (closed form) ------------------------------------------------------

def test_capacity_shortfall_scenario(spark):
    pct = 55 + np.linspace(0, 40, 90)
    used = np.round(pct / 100 * 1000, 2)
    raw = storage_df(spark, [(day(i), "storage-shortfall-scenario", float(used[i]), 1000.0, float(round(pct[i], 2)),
                              float(min(100.0, pct[i] * 0.4 + 20))) for i in range(90)])
    trends = process_storage_trends(clean_storage(raw))
    s = prepare_series(trends, "storage_id", "date", "disk_utilization_pct", "storage")
    cur = rules.latest_value(trends, "storage_id", "disk_utilization_pct")
    out = rules.rule_storage(cur, rules.horizon_peaks(forecast_linear(s))).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.recommendation_type, r.risk_level, r.forecast_horizon_weeks) == ("increase_storage_capacity", "critical", 4)
    assert r.current_value == 95.0
    assert abs(r.forecasted_value - (55 + 117 * 40 / 89)) < 0.01


def test_chronic_waste_scenario(spark):
    raw = compute_df(spark, [(hour(i), "cluster-waste-scenario", 20.0, 18.0, 20.0) for i in range(90 * 24)])
    r = rules.rule_compute(process_compute_trends(clean_compute(raw))).first()
    assert (r.recommendation_type, r.risk_level) == ("downsize_underutilized_compute", "warning")
    assert dict(r.details) == {"days_below_threshold": 90.0}


def test_seasonal_spike_scenario(spark):
    n = 60 * 24
    pct = np.full(n, 25.0)
    pct[720:840] = 92.0
    raw = network_df(spark, [(hour(i), "network-spike-scenario", 2000.0, float(round(pct[i] / 100 * 2000, 2)),
                              float(round(20 + pct[i] * 1.2, 2))) for i in range(n)])
    r = rules.rule_network(process_network_trends(clean_network(raw))).first()
    assert (r.recommendation_type, r.risk_level, dict(r.details)) == (
        "enable_temporary_autoscaling", "warning", {"spike_days": 5.0})
    assert r.forecasted_value == 100.0
    assert abs(r.current_value - (55 * (500 / 1840 * 100) + 500) / 60) < 1e-9


def test_recommend_with_prophet_slot_equals_linear(spark):
    raw = storage_df(spark, [(day(i), "s", 500.0 + 5 * i, 1000.0, None, 10.0) for i in range(60)])
    trends = {"storage": process_storage_trends(clean_storage(raw)),
              "compute": process_compute_trends(clean_compute(compute_df(spark, [(hour(0), "c", 50.0, 1.0, 50.0)]))),
              "network": process_network_trends(clean_network(network_df(spark, [(hour(0), "n", 1.0, 1.0, 1.0)])))}
    key = lambda r: (r.resource_id, r.risk_level, r.forecast_horizon_weeks, round(r.forecasted_value, 9))
    a = sorted(map(key, rules.recommend(trends, rule_model="prophet").collect()))
    b = sorted(map(key, rules.recommend(trends).collect()))
    assert a == b and ("s", "critical", 4) in [x[:3] for x in a]
