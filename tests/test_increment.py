"""Increments: the same tables as a full run, from the touched days alone."""

import contextlib
import datetime as dt
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from headroom.operators.cleaning import CLEANERS
from headroom.operators.trends import TREND_BUILDERS, aggregate_daily, merge_rollups, rollup_daily, rollup_means
from headroom.plans.increment import DayStore
from headroom.schemas import COMPUTE, COMPUTE_SCHEMA, KINDS, NETWORK, STORAGE
from headroom.session import fresh_path
from pyspark.sql import types as T

T0 = dt.datetime(2025, 1, 1)


def compute_rows(seed: int, days: range, ids=("a", "b", "c", None), per_day: int = 4, hole: float = 0.2):
    """Hourly rows with repeated keys, missing values and days without rows."""
    rng = random.Random(seed)
    rows = []
    for day in days:
        for who in ids:
            if rng.random() < 0.25:
                continue
            for _ in range(per_day):
                at = T0 + dt.timedelta(days=day, hours=rng.randrange(6))
                cpu = None if rng.random() < hole else rng.uniform(-20, 130)
                target = None if rng.random() < 0.5 else rng.uniform(0, 100)
                rows.append((None if rng.random() < 0.02 else at, who, cpu, rng.uniform(0, 100), target))
    return rows


def frame(spark, rows, start=0):
    schema = T.StructType([*COMPUTE_SCHEMA.fields, T.StructField("seq", T.LongType())])
    return spark.createDataFrame([(*r, start + i) for i, r in enumerate(rows)], schema)


def same(got, want, keys):
    def table(df):
        return sorted(tuple(repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v) for v in (r[c] for c in (*keys, *sorted(set(df.columns) - set(keys)))))
                      for r in df.collect())
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got) == table(want)


def check(spark, store, landed):
    """The store against a full run over all that has landed, the earlier run's copy first."""
    cleaned = CLEANERS["compute"](frame(spark, [r for part in landed for r in part])).drop("seq")
    same(store.cleaned(), cleaned, ["timestamp", "cluster_id"])
    same(store.daily(), aggregate_daily(cleaned, "cluster_id", COMPUTE.daily_cols), ["cluster_id", "date"])
    same(store.trends(), TREND_BUILDERS["compute"](cleaned), ["cluster_id", "date"])


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_runs_equal_a_full_run(spark, grain):
    store = DayStore(spark, fresh_path(spark, "days"), "compute", grain=grain)
    parts = [compute_rows(1, range(0, 45)), compute_rows(2, range(45, 47)), compute_rows(3, range(46, 50)),   # a day in two runs
             compute_rows(4, range(10, 12)), compute_rows(5, range(50, 53)),                                   # late days, then a new one
             compute_rows(1, range(0, 3)), [(None, "a", 1.0, 1.0, 1.0)], [], compute_rows(6, range(90, 92))]  # repeated, undated, empty, a gap
    for run, rows in enumerate(parts):
        store.add(frame(spark, rows), run)
        if run in (2, 3, 8):
            check(spark, store, parts[:run + 1])


def test_a_repeated_run_changes_nothing(spark):
    store = DayStore(spark, fresh_path(spark, "days"), "compute")
    parts = [compute_rows(1, range(0, 8)), compute_rows(2, range(5, 10))]
    for run, rows in enumerate(parts):
        store.add(frame(spark, rows), run)
    store.add(frame(spark, parts[1]), 1)
    check(spark, store, parts)


@pytest.mark.parametrize("stop", ["own_rollup", "_rebuild", "tails"])
def test_a_run_that_stopped_is_run_again(spark, monkeypatch, stop):
    store = DayStore(spark, fresh_path(spark, "days"), "compute")
    parts = [compute_rows(1, range(0, 8)), compute_rows(2, range(5, 10)), compute_rows(7, range(3, 5))]
    store.add(frame(spark, parts[0]), 0)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DayStore, stop, fail)
        with pytest.raises(RuntimeError):
            store.add(frame(spark, parts[1]), 1)
    store.add(frame(spark, parts[1]), 1)
    store.add(frame(spark, parts[2]), 2)
    check(spark, store, parts)


def test_the_last_present_value_is_carried_over_the_tail(spark):
    rows = [(T0 + dt.timedelta(days=d), "a", 1.0, 1.0, 50.0 if d in (0, 40) else None) for d in range(41)]
    store = DayStore(spark, fresh_path(spark, "days"), "compute")
    store.add(frame(spark, rows[:40]), 0)
    store.add(frame(spark, rows[40:]), 1)
    check(spark, store, [rows])
    last = store.trends().orderBy(F.col("date").desc()).first()
    assert last.cluster_utilization_pct_growth_rate == 0.0 and last.cluster_utilization_pct_ma30 == 50.0
    assert store.tails(store.daily(), [dt.date(2025, 2, 10), dt.date(2025, 1, 20)]).count() == 30 + 20


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_a_second_run_reads_its_days_and_the_tails_alone(spark):
    store = DayStore(spark, fresh_path(spark, "days"), "compute")
    store.add(frame(spark, compute_rows(1, range(0, 60))), 0)
    touched = store.add(frame(spark, compute_rows(2, range(59, 62))), 1)
    assert [d.day for d in touched.days] == [1, 2, 3]
    keys = plan(store.new_rows(store.first().where("run = 1").drop("run"), touched, 1))
    assert re.search(r"PartitionFilters: \[.*period#\d+ IN .*run#\d+L? < 1", keys) or re.search(r"PartitionFilters: \[.*run#\d+L? < 1.*period#\d+", keys)
    assert [r.run for r in store.runs().orderBy("run").collect()] == [0, 1]
    for day, oldest in ((touched.days[-1], 2), (touched.days[0], 4), (dt.date(2025, 2, 20), 25)):  # the newest day again, a day before, a late day
        history = store.history(day, 2)
        filters = re.findall(r"PartitionFilters: \[(.*)\]", plan(history))
        assert any("as_of" in f and "run" in f for f in filters)
        assert any("period" in f and ">=" in f for f in filters)
        base = store._newest_tails(day, 2)[0]
        assert base < day and (touched.days[-1] - base).days <= oldest


def test_rollups_of_disjoint_rows_merge(spark):
    for kind in (COMPUTE, STORAGE, NETWORK):
        rng = random.Random(kind.name)
        rows = [(T0 + dt.timedelta(hours=rng.randrange(100)), rng.choice(["x", "y", None]),
                 *[None if rng.random() < 0.3 else rng.uniform(0, 9) for _ in kind.columns[2:]]) for _ in range(200)]
        df = spark.createDataFrame(rows, KINDS[kind.name].schema)
        half = F.pmod(F.xxhash64(*kind.columns), F.lit(3))
        parts = [rollup_daily(df.where(half == i), kind.id_col, kind.daily_cols) for i in range(3)]
        merged = merge_rollups(parts[0].unionByName(parts[1]), kind.id_col, kind.daily_cols)
        merged = merge_rollups(merged.unionByName(parts[2]), kind.id_col, kind.daily_cols)
        same(rollup_means(merged, kind.id_col, kind.daily_cols), aggregate_daily(df, kind.id_col, kind.daily_cols), [kind.id_col, "date"])


def test_tails_of_many_days_are_one_pass(spark):
    """Each day's tail by a plain loop, and no row is copied per day before the resource's rows are together."""
    history = spark.createDataFrame(
        [(who, (T0 + dt.timedelta(days=d)).date(), None if d % hole else float(d)) for who, hole in (("a", 1), ("b", 7), ("c", 45)) for d in range(0, 90, 2 if who == "b" else 1)],
        "cluster_id string, date date, cluster_utilization_pct double")
    days = [(T0 + dt.timedelta(days=d)).date() for d in (89, 88, 60, 29, 3)]
    rows = [tuple(r) for r in history.collect()]
    want = set()
    for day in days:
        for who in "abc":
            own = sorted((r for r in rows if r[0] == who and r[1] <= day), key=lambda r: r[1])
            want |= {(*r, day) for r in own[-30:] + [r for r in own if r[2] is not None][-1:]}
    got = DayStore(spark, fresh_path(spark, "days"), "compute").tails(history, days)
    text = plan(got)
    assert text.index("Generate") < text.index("Window") < text.index("Exchange")  # the days come last
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("grain", ["month", "year"])
def test_few_periods_are_written_without_a_shuffle(spark, grain, monkeypatch):
    store, hinted = DayStore(spark, fresh_path(spark, "days"), "compute", grain=grain), []
    monkeypatch.setattr(type(spark.range(0)), "hint", lambda self, *a: hinted.append(a) or self)
    store.add(frame(spark, compute_rows(1, range(0, 40))), 0)
    store.add(frame(spark, compute_rows(2, range(38, 42))), 1)
    assert len(hinted) == 2  # the log of runs alone
    check(spark, store, [compute_rows(1, range(0, 40)), compute_rows(2, range(38, 42))])
