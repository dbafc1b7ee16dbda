import math

import numpy as np
import pandas as pd
import pytest

from headroom.operators.trends import add_trend_indicators, aggregate_daily, process_compute_trends
from tests.conftest import d, hour
from tests.frames import DAILY_COMPUTE, compute_df


def _daily(spark, values, dates=None):
    dates = dates or [d(i) for i in range(len(values))]
    return spark.createDataFrame([("c1", ds, v) for ds, v in zip(dates, values)], DAILY_COMPUTE)


def _trend(spark, values, fill="ffill", dates=None):
    out = add_trend_indicators(_daily(spark, values, dates), "cluster_id", "cluster_utilization_pct", fill=fill)
    return out.orderBy("date").toPandas()


def test_hourly_to_daily(spark):
    df = compute_df(spark, [(hour(i), "c1", float(i), float(i), float(i)) for i in range(48)])
    out = aggregate_daily(df, "cluster_id", ["cpu_utilization_pct"]).orderBy("date").collect()
    assert [r.cpu_utilization_pct for r in out] == [11.5, 35.5]
    assert [r.date for r in out] == [d(0), d(1)]


def test_daily_drops_null_ids_and_ignores_missing_values(spark):
    df = compute_df(spark, [(hour(0), None, 1.0, 1.0, 1.0), (hour(1), "c1", 10.0, 1.0, None),
                            (hour(2), "c1", 20.0, 1.0, 4.0)])
    out = aggregate_daily(df, "cluster_id", ["cpu_utilization_pct", "cluster_utilization_pct"]).collect()
    assert len(out) == 1 and out[0].cpu_utilization_pct == 15.0 and out[0].cluster_utilization_pct == 4.0


def test_constant_compute_ma7(spark):
    df = compute_df(spark, [(hour(i), "c1", 50.0, 40.0, 45.0) for i in range(48)])
    out = process_compute_trends(df).collect()
    assert len(out) == 2 and all(r.cluster_utilization_pct_ma7 == 45.0 for r in out)


def test_ramp_matches_pandas(spark):
    vals = [float(i) for i in range(40)]
    got = _trend(spark, vals)
    s = pd.Series(vals)
    np.testing.assert_allclose(got["cluster_utilization_pct_ma7"], s.rolling(7, min_periods=1).mean())
    np.testing.assert_allclose(got["cluster_utilization_pct_ma30"], s.rolling(30, min_periods=1).mean())
    want = (s / s.shift(1) - 1).fillna(0)  # pct_change with the first row 0
    np.testing.assert_allclose(got["cluster_utilization_pct_growth_rate"], want)


def test_growth_zero_and_inf(spark):
    got = list(_trend(spark, [0.0, 5.0, 0.0, 0.0])["cluster_utilization_pct_growth_rate"])
    assert got[0] == 0 and math.isinf(got[1]) and got[1] > 0 and got[2] == -1 and got[3] == 0


def test_growth_forward_fill_vs_none(spark):
    assert list(_trend(spark, [10.0, None, 20.0])["cluster_utilization_pct_growth_rate"]) == [0.0, 0.0, 1.0]
    assert list(_trend(spark, [10.0, None, 20.0], fill="none")["cluster_utilization_pct_growth_rate"]) == [0.0, 0.0, 0.0]


def test_ma_uses_rows_not_days(spark):
    got = _trend(spark, [1.0, 2.0, 6.0], dates=[d(0), d(1), d(9)])
    assert list(got["cluster_utilization_pct_ma7"]) == [1.0, 1.5, 3.0]


def test_ma_all_missing_window_is_missing(spark):
    got = _trend(spark, [None, None])
    assert got["cluster_utilization_pct_ma7"].isna().all()


def test_bad_fill_rejected(spark):
    with pytest.raises(ValueError):
        _trend(spark, [1.0], fill="bfill")
