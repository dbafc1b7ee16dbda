"""Streams of landed files without an order column, and indicators with keyed state."""

import csv
import datetime as dt
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from headroom.functions.numeric import packed_order
from headroom.operators.cleaning import CLEANERS, clean_compute
from headroom.operators.trends import TREND_BUILDERS, add_trend_indicators, aggregate_daily
from headroom.plans.increment import DayStore
from headroom.schemas import COMPUTE, COMPUTE_COLUMNS
from headroom.session import fresh_path
from headroom.sources.files import read_metrics
from headroom.streaming.days import finished, stream_days
from headroom.streaming.indicators import daily_schema, stream_trends
from tests.test_increment import compute_rows, same


def land(folder: str, name: str, rows, columns=COMPUTE_COLUMNS) -> None:
    """One CSV file; files land at least a few milliseconds apart."""
    os.makedirs(folder, exist_ok=True)
    order = [COMPUTE_COLUMNS.index(c) for c in columns]
    with open(os.path.join(folder, name), "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        for r in rows:
            out.writerow(["" if r[i] is None else r[i] for i in order])
    time.sleep(0.02)


@pytest.mark.parametrize("files_per_batch", [1, 3, None])
def test_stream_over_raw_files_equals_batch(spark, files_per_batch):
    base = tempfile.mkdtemp(prefix="headroom-days-")
    folder = f"{base}/landing"
    # Names run against the order of landing; days reappear late, one file is repeated, one is empty.
    parts = [compute_rows(1, range(0, 6)), compute_rows(2, range(4, 9)), compute_rows(3, range(1, 3)), [], compute_rows(1, range(0, 6)), compute_rows(9, range(9, 10))]

    def run():
        finished(stream_days(spark, folder, "compute", f"{base}/store", f"{base}/checkpoint", max_files_per_trigger=files_per_batch))

    for i, rows in enumerate(parts):
        land(folder, f"{chr(ord('z') - i)}.csv", rows)
        if i == 2:
            run()
    run()
    cleaned = clean_compute(read_metrics(spark, folder, "compute", on_violation="report", order="landed"))
    store = DayStore(spark, f"{base}/store", "compute")
    same(store.cleaned(), cleaned.drop("seq"), ["timestamp", "cluster_id"])
    same(store.daily(), aggregate_daily(cleaned, "cluster_id", COMPUTE.daily_cols), ["cluster_id", "date"])  # open days too
    same(store.trends(), TREND_BUILDERS["compute"](cleaned), ["cluster_id", "date"])


def test_first_file_counts_by_path_or_by_landing(spark):
    folder = tempfile.mkdtemp(prefix="headroom-order-") + "/a b%20c"
    at = dt.datetime(2025, 1, 1)
    land(folder, "z.csv", [(at, "c", 1.0, 1.0, 1.0), (at, "c", 2.0, 1.0, 1.0)])
    land(folder, "a.csv", [(at, "c", 3.0, 1.0, 1.0)])

    def kept(order):
        return [r.cpu_utilization_pct for r in clean_compute(read_metrics(spark, folder, "compute", order=order)).collect()]

    assert kept("path") == [3.0] and kept("landed") == [1.0]
    with pytest.raises(ValueError):
        kept("size")


def test_packed_order_sorts_like_the_tuple(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 0, 1, 99]), rng.choice([None, 0, 7, 10 ** 13 - 2]), rng.choice([0, 5, 2 ** 63 - 2])) for _ in range(200)]
    df = spark.createDataFrame(rows, "a int, b long, c long").withColumn("p", packed_order(("a", 6), ("b", 13), ("c", 19)))
    got = [tuple(r)[:3] for r in df.orderBy("p").collect()]
    assert got == sorted(got, key=lambda r: tuple((v is not None, v or 0) for v in r))
    with pytest.raises(ValueError):
        packed_order(("a", 30), ("b", 9))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(packed_order(("c", 2))).collect()


def test_no_sort_aggregate_where_the_first_row_is_kept(spark, tmp_path):
    from __spark_entry__ import queries
    from tests.test_plans import plan
    assert "SortAggregate" not in plan(queries()["clean_storage"](spark, "/root/testdata/sf0.001"))
    land(str(tmp_path), "a.csv", compute_rows(1, range(2)))
    for order in ("path", "landed"):
        text = plan(CLEANERS["compute"](read_metrics(spark, str(tmp_path), "compute", on_violation="report", order=order)))
        assert "SortAggregate" not in text and "HashAggregate" in text


def test_indicators_of_a_stream_equal_the_batch_after_restarts(spark):
    rng = random.Random(6)
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(75)]
    rows = [(who, d, 1.0, None if rng.random() < 0.2 else 2.0, value) for who in ("a", "b", "c") for d in days if rng.random() < 0.8
            for value in [None if rng.random() < 0.3 or (who == "c" and 5 < d.timetuple().tm_yday < 60) else rng.choice([0.0, 0.0, rng.uniform(-5, 90)])]]
    schema = daily_schema(COMPUTE)
    base = fresh_path(spark, "indicators")
    for i, cut in enumerate([(0, 3), (3, 40), (40, 41), (41, 75)]):
        part = [r for r in rows if days[cut[0]] <= r[1] <= days[cut[1] - 1]]
        rng.shuffle(part)
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(f"{base}/in")
        finished(stream_trends(spark, f"{base}/in", "compute", f"{base}/out", f"{base}/checkpoint", 3))
    late = spark.createDataFrame([("a", days[0], 1.0, 1.0, 1.0), (None, days[-1], 1.0, 1.0, 1.0)], schema)
    late.write.mode("append").parquet(f"{base}/in")
    finished(stream_trends(spark, f"{base}/in", "compute", f"{base}/out", f"{base}/checkpoint", 3))
    want = add_trend_indicators(spark.createDataFrame(rows, schema), "cluster_id", COMPUTE.target)
    same(spark.read.parquet(f"{base}/out"), want.where(F.col("cluster_id").isNotNull()), ["cluster_id", "date"])
