"""Sorted and bucketed tables."""

import random
import re

from pyspark.sql import functions as F

from headroom.operators import rules, series
from headroom.operators.forecast import forecast_linear, forecast_peaks
from headroom.plans.capacity_job import recommend_bucketed, run_export
from headroom.plans.catalog import daily_tables
from headroom.session import fresh_path
from headroom.sources.files import write_sorted
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


def test_sorted_files_do_not_overlap_and_a_hot_id_is_split(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", f"id{rng.randrange(40)}", None]), rng.choice([None, *range(1000)]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "id string, at long, v long").repartition(5)
    path = fresh_path(spark, "sorted")
    assert write_sorted(df, path, ("id", "at"), files=8, rows_per_file=600)[1] == 4000
    per_file = {}
    for r in spark.read.parquet(path).select("id", "at", "v", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).collect():
        per_file.setdefault(r.f, []).append((r.i, (r.id is None, r.id or "", r.at is None, r.at or 0)))
    spans = []
    for found in per_file.values():
        keys = [k for _, k in sorted(found)]
        assert keys == sorted(keys) and len(keys) <= 600
        spans.append((keys[0], keys[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sum(a[1] <= "hot" <= b[1] for a, b in spans if not a[0]) > 1  # the hot id fills several files
    one = [f for f, found in per_file.items() if any(k[1] == "id7" for _, k in found)]
    assert len(one) <= 2
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == sorted(rows, key=repr)


def test_exported_overview_is_sorted(spark):
    out = fresh_path(spark, "export")
    trends = daily_tables(spark, SF)
    recs = rules.recommend(trends)
    run_export(trends, recs, out, {})
    got = spark.read.option("header", True).csv(f"{out}/export/utilization_overview").select("resource_type", "resource_id", "date", F.col("_metadata.file_path").alias("f"))
    files = {}
    for r in got.collect():
        files.setdefault(r.f, []).append((r.resource_type, r.resource_id, r.date))
    assert all(v == sorted(v) for v in files.values())
    spans = sorted((v[0], v[-1]) for v in files.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_bucketed_tables_join_without_an_exchange(spark):
    trends = daily_tables(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables too large to broadcast
    try:
        got = recommend_bucketed(spark, trends, fresh_path(spark, "bucketed"), buckets=4)
        for name in ("peaks", "storage"):
            assert not re.search(r"^\(\d+\) Exchange", plan(got[name]), re.M), name
        s = series.prepare_all(trends)
        want = rules.rule_storage(forecast_peaks(s.where("resource_type = 'storage'")).drop("resource_type"))
        key = lambda df: sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())
        columns = want.columns
        assert key(got["storage"].select(*columns)) == key(want)
        linear = forecast_linear(s).select("resource_id", "horizon_weeks", "step", F.round("yhat", 6).alias("y"))
        mine = got["forecasts"].where("model = 'linear_regression'").select("resource_id", "horizon_weeks", "step", F.round("yhat", 6).alias("y"))
        assert mine.exceptAll(linear).count() == 0 == linear.exceptAll(mine).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
