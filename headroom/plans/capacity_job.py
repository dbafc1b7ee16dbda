"""The batch job (E1-E5): raw tables -> cleaned -> trends -> forecasts -> recommendations -> exports.

Every stage boundary is a written table in the job folder (parquet), re-read by the next
stage: lineage stays short, a lost executor only recomputes from the last written table,
and the large raw input is scanned once. A stage's shuffle files go when its table is written. Stages that don't read each other's tables are submitted
together, so the last tasks of one don't leave the cluster idle.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.util import inheritable_thread_target

from headroom.config import LINEAR, SEASONAL, STORAGE_RULE_HORIZONS, Thresholds
from headroom.operators import export, forecast, narrative, rules, series
from headroom.operators.cleaning import CLEANERS
from headroom.operators.quality import broken, observe_quality, raise_on_violations
from headroom.operators.trends import TREND_BUILDERS
from headroom.plans.increment import DayStore
from headroom.session import fresh_path, freed_shuffles
from headroom.sources import adapters
from headroom.sources.files import RAW_FILES, land_recommendations, read_all, write_bucketed, write_interim, write_sorted, write_table

logger = logging.getLogger(__name__)


def _done(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a completely written table (its ``_SUCCESS`` marker exists)."""
    try:
        spark.read.text(f"{path}/_SUCCESS").schema  # resolving the path lists it; no job runs
        return True
    except AnalysisException:
        return False


def _note(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` beside the table at ``path``: what it was made with."""
    spark.createDataFrame([(text,)], "made_with string").coalesce(1).write.mode("overwrite").parquet(f"{path}_made_with")


def _noted(spark: SparkSession, path: str) -> str | None:
    """The note of a completely written table, else None."""
    if not (_done(spark, path) and _done(spark, f"{path}_made_with")):
        return None
    return spark.read.parquet(f"{path}_made_with").first().made_with  # one row


def _persist(spark: SparkSession, df: DataFrame, path: str, log: dict, resume: bool = False,
             made_with: str | None = None) -> DataFrame:
    """Write a stage boundary and re-read it. With ``resume`` a completed table is reused, so a
    re-run after a failure starts from the last finished stage; where the table depends on
    parameters (``made_with``), only if its note names the same ones. The note is blanked
    before the table is rewritten, so a run that stops in between leaves nothing to reuse."""
    name = path.rsplit("/", 1)[-1]
    if resume and (_done(spark, path) if made_with is None else _noted(spark, path) == made_with):
        log[name] = -1
        return spark.read.parquet(path)
    if made_with is not None:
        _note(spark, path, "")
    p, rows = write_table(df, path)
    if made_with is not None:
        _note(spark, path, made_with)
    log[name] = rows
    return spark.read.parquet(p)


def _together(spark: SparkSession, log: dict, *steps: Callable[[dict], Any]) -> list:
    """Run ``steps`` at once, each with a log of its own, and return their results in order.

    All of them end before this returns or the first failure is raised; their logs join ``log`` in
    the order of the steps, however they ended."""
    logs: list[dict] = [{} for _ in steps]
    wrap = inheritable_thread_target(spark)  # job group, pool and the like hold in the threads too
    with ThreadPoolExecutor(len(steps)) as pool:
        runs = [pool.submit(wrap(step), own) for step, own in zip(steps, logs, strict=True)]
    for own in logs:
        log.update(own)
    return [run.result() for run in runs]


def run_clean_and_trend(spark: SparkSession, raw: Mapping[str, DataFrame], out_dir: str, log: dict,
                        resume: bool = False):
    """Cleaned and trend tables for the three kinds, each written and re-read."""
    def of(k: str) -> Callable[[dict], DataFrame]:
        def step(own: dict) -> DataFrame:
            cleaned = _persist(spark, CLEANERS[k](raw[k]), f"{out_dir}/processed/{k}_cleaned", own, resume)
            return _persist(spark, TREND_BUILDERS[k](cleaned), f"{out_dir}/processed/{k}_trends", own, resume)
        return step

    return dict(zip(raw, _together(spark, log, *map(of, raw)), strict=True))


JOB_MODELS = (LINEAR, SEASONAL)


def _forecast_parameters(horizons_weeks: Sequence[int] | None, models: Sequence[str] = JOB_MODELS) -> str:
    return f"horizons={None if horizons_weeks is None else list(horizons_weeks)} models={list(models)}"


def run_forecast(spark: SparkSession, trends: Mapping[str, DataFrame], out_dir: str, log: dict,
                 horizons_weeks: Sequence[int] | None = None, resume: bool = False,
                 models: Sequence[str] = JOB_MODELS) -> DataFrame:
    """One long series table -> every model slot for every resource -> written forecasts."""
    s = _persist(spark, series.prepare_all(trends), f"{out_dir}/processed/series", log, resume)

    def count(own: dict) -> None:
        own.update({f"series_{r.resource_type}": r.n_resources for r in series.resource_counts(s).collect()})  # one row per resource type
        logger.info("[FORECASTED] %s", own)

    def status(own: dict) -> None:
        _persist(spark, forecast.forecast_status(s), f"{out_dir}/processed/forecast_status", own, resume)

    def forecasts(own: dict) -> DataFrame:
        out = forecast.forecast_all(s, horizons_weeks, models, spread=int(spark.conf.get("spark.sql.shuffle.partitions")))
        return _persist(spark, out, f"{out_dir}/processed/forecasts", own, resume, _forecast_parameters(horizons_weeks, models))

    return _together(spark, log, count, status, forecasts)[-1]


def run_recommend(spark: SparkSession, trends, forecasts: DataFrame, out_dir: str, log: dict,
                  th: Thresholds = Thresholds(), rule_model: str = LINEAR, provider: str = "template_fallback",
                  responses: DataFrame | None = None, resume: bool = False, made_with: str = "") -> DataFrame:
    """Rules + narratives, persisted (parquet for the job, CSV with JSON details for BI).

    ``made_with`` names what the forecasts were made with. Recommendations with ``responses``
    are never reused on resume: nothing says that those are the same responses."""
    recs = narrative.narrate(rules.recommend(trends, forecasts, th, rule_model), responses, provider)
    recs = _persist(spark, recs, f"{out_dir}/processed/recommendations", log, resume and responses is None,
                    f"{made_with} {th} rule_model={rule_model} provider={provider} responses={responses is not None}")

    def land(own: dict) -> None:
        _, own["recommendations_csv"] = land_recommendations(recs, f"{out_dir}/processed/recommendations_csv")

    def count(own: dict) -> None:
        counts = rules.risk_counts(recs).first()  # one row
        own["critical"], own["warning"] = counts.critical_count, counts.warning_count
        logger.info("[SUMMARY] %d critical, %d warning recommendation(s)", counts.critical_count, counts.warning_count)

    _together(spark, log, land, count)
    return recs


def export_overview(trends, out_dir: str, log: dict) -> None:
    """The overview as headered CSV by resource and date (``trends`` are written tables).

    Its files are gzipped: as plain text this one export, a row for each resource and day, would be a third of the job's disk."""
    _, log["utilization_overview"] = write_sorted(export.utilization_overview(trends), f"{out_dir}/export/utilization_overview",
                                                  ("resource_type", "resource_id", "date"), "csv", compression="gzip")


def export_recommendations(recs: DataFrame, out_dir: str, log: dict) -> None:
    """The recommendations and their risk summary as headered CSV."""
    def land(own: dict) -> None:
        _, own["export_recommendations"] = land_recommendations(recs, f"{out_dir}/export/recommendations")

    def risks(own: dict) -> None:
        _, own["risk_summary"] = write_table(export.risk_summary(recs), f"{out_dir}/export/risk_summary", "csv")

    _together(recs.sparkSession, log, land, risks)


def run_export(trends, recs: DataFrame, out_dir: str, log: dict) -> None:
    """The three dashboard tables as headered CSV."""
    _together(recs.sparkSession, log, lambda own: export_overview(trends, out_dir, own),
              lambda own: export_recommendations(recs, out_dir, own))


def _run_after_trends(spark: SparkSession, trends, out_dir: str, log: dict, horizons_weeks: Sequence[int] | None, th: Thresholds,
                      rule_model: str, provider: str, responses: DataFrame | None, resume: bool = False) -> None:
    """The overview needs the trends alone and is written beside the forecasts."""
    def overview(own: dict) -> None:
        export_overview(trends, out_dir, own)

    def forecasts_on(own: dict) -> None:
        forecasts = run_forecast(spark, trends, out_dir, own, horizons_weeks, resume)
        recs = run_recommend(spark, trends, forecasts, out_dir, own, th, rule_model, provider, responses, resume,
                             _forecast_parameters(horizons_weeks))
        export_recommendations(recs, out_dir, own)

    _together(spark, log, forecasts_on, overview)


def run_job(spark: SparkSession, raw: Mapping[str, DataFrame], out_dir: str, th: Thresholds = Thresholds(),
            horizons_weeks: Sequence[int] | None = None, rule_model: str = LINEAR,
            provider: str = "template_fallback", responses: DataFrame | None = None,
            resume: bool = False) -> dict[str, int]:
    """E5: the whole job; returns rows written per table (-1 for a table reused on resume).

    ``resume`` expects the same raw tables as the earlier run; a stage made with other
    horizons, thresholds or models is made again."""
    log: dict[str, int] = {}
    with freed_shuffles(spark):
        trends = run_clean_and_trend(spark, raw, out_dir, log, resume)
        _run_after_trends(spark, trends, out_dir, log, horizons_weeks, th, rule_model, provider, responses, resume)
    return log


def job_folder(spark: SparkSession, sf_dir: str) -> str:
    """Run the job on the metric tables derived from ``sf_dir``; the folder that it wrote."""
    out = fresh_path(spark, "capacity-job")
    run_job(spark, adapters.raw_all(spark, sf_dir, dedupe_before_lookup=True), out)
    return out


def run_on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the job on the metric tables derived from ``sf_dir``; return the recommendations as
    read back from the written export."""
    recs = spark.read.parquet(f"{job_folder(spark, sf_dir)}/processed/recommendations")
    return recs.withColumn("details", F.to_json("details"))


def read_export(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """One of the job's CSV exports, as a dashboard reads it."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)
            .csv(f"{folder}/export/{name}"))


def recommend_bucketed(spark: SparkSession, trends: Mapping[str, DataFrame], out_dir: str, buckets: int | None = None,
                       horizons_weeks: Sequence[int] | None = None, model: str = LINEAR) -> dict[str, DataFrame]:
    """E2/E3 on tables bucketed by resource: series, forecasts and storage rule without an exchange between them.

    Every table is bucketed by (resource_type, resource_id) into as many buckets, sorted by date, so
    the fits (F2, F6), the peaks (A7), the lookup of the forecasts (J1) and the storage rule (R1)
    read their resource's rows where they are. Returns the lazy ``forecasts``, ``peaks`` and ``storage`` rows.
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = write_bucketed(series.prepare_all(trends), f"{out_dir}/bucketed/series", forecast.KEY, n, ("ds",))
    forecasts = write_bucketed(forecast.forecast_all(s, horizons_weeks), f"{out_dir}/bucketed/forecasts", forecast.KEY, n, ("model", "ds"))
    latest = s.where((F.col("resource_type") == "storage")).groupBy(*forecast.KEY).agg(F.max_by("y", "ds").alias("current_value"))
    chosen = forecasts.where((F.col("model") == model) & (F.col("resource_type") == "storage"))
    peaks = chosen.groupBy(*forecast.KEY).agg(*[F.max(F.when(F.col("horizon_weeks") == h, F.col("yhat"))).alias(f"peak_{h}")
                                                for h in STORAGE_RULE_HORIZONS])
    joined = latest.join(peaks, list(forecast.KEY), "left")
    return {"forecasts": forecasts, "peaks": joined, "storage": rules.rule_storage(joined.drop("resource_type"))}


def run_increment(spark: SparkSession, raw: Mapping[str, DataFrame], out_dir: str, run: int, grain: str = "day",
                  th: Thresholds = Thresholds(), horizons_weeks: Sequence[int] | None = None, rule_model: str = LINEAR,
                  provider: str = "template_fallback", responses: DataFrame | None = None) -> dict[str, int]:
    """E1-E4 for one night: the rows of this run alone go into the day stores under ``out_dir/days``
    (see :mod:`headroom.plans.increment`), the later stages read the trends that these hold.

    ``raw`` has what landed since the last run, for any of the kinds. Runs are numbered upwards; a
    run that failed is repeated under its number."""
    log: dict[str, int] = {}
    trends = {}
    for kind in RAW_FILES:
        store = DayStore(spark, f"{out_dir}/days/{kind}", kind, grain=grain)
        if kind in raw:
            log[f"{kind}_days"] = len(store.add(raw[kind], run).days)
        trends[kind] = store.trends()
    _run_after_trends(spark, trends, out_dir, log, horizons_weeks, th, rule_model, provider, responses)
    return log


def run_from_raw_dir(spark: SparkSession, raw_dir: str, out_dir: str, fmt: str = "csv",
                     on_violation: str = "fail", resume: bool = False, **job_args) -> dict[str, int]:
    """E5 over landed files: S2 read (validated) -> S3 interim -> E1..E4 on the interim tables.

    The outcome of the quality rules is noted beside each interim table. ``resume`` reuses the
    interim tables only if they come from the same files and, with ``on_violation="fail"``,
    broke no rule; otherwise the files are read and checked again and every stage is made anew."""
    interim_dir = f"{out_dir}/interim"
    paths = {k: f"{interim_dir}/{k}_ingested" for k in RAW_FILES}
    log: dict[str, int] = {}
    usable = {f"{fmt} {raw_dir} passed"} | ({f"{fmt} {raw_dir} violated"} if on_violation == "report" else set())
    resume = resume and all(_noted(spark, p) in usable for p in paths.values())
    if resume:
        interim = {k: spark.read.parquet(p) for k, p in paths.items()}
    else:
        for p in paths.values():
            _note(spark, p, "")
        # The quality rules ride on the interim write (one pass over the raw files); with
        # "fail" the job stops right after it, before any cleaning.
        raw = read_all(spark, raw_dir, fmt, on_violation="report")
        observed = {k: observe_quality(df, k) for k, df in raw.items()}
        written = write_interim({k: df for k, (df, _) in observed.items()}, interim_dir)
        for k, (_, obs) in observed.items():
            log.update({f"{k}_{rule}": n for rule, n in obs.get.items()})
            _note(spark, paths[k], f"{fmt} {raw_dir} {'violated' if broken(obs, k) else 'passed'}")
        for k, (_, obs) in observed.items():
            if on_violation == "fail":
                raise_on_violations(obs, k)
        log.update({f"{k}_ingested": rows for k, (_, rows) in written.items()})
        interim = {k: spark.read.parquet(p) for k, (p, _) in written.items()}
    log.update(run_job(spark, interim, out_dir, resume=resume, **job_args))
    return log


def main(argv: Sequence[str] | None = None) -> None:
    import argparse
    import json

    ap = argparse.ArgumentParser(description="capacity job: raw metric files -> recommendations and dashboard tables")
    ap.add_argument("--raw-dir", required=True, help="folder with compute_metrics, storage_metrics, network_metrics")
    ap.add_argument("--out-dir", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--on-violation", default="fail", choices=["fail", "report"])
    ap.add_argument("--horizons", default="4,12", help="forecast horizons in weeks")
    ap.add_argument("--rule-model", default=LINEAR)
    ap.add_argument("--resume", action="store_true")
    ap.add_argument("--run", type=int, help="take the files as the increment of this number, not as the whole history")
    ap.add_argument("--grain", default="day", choices=["day", "month", "year"], help="partitions of an increment's tables")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("headroom-capacity-job").getOrCreate()
    horizons = [int(h) for h in a.horizons.split(",") if h]
    if a.run is not None:
        raw = read_all(spark, a.raw_dir, a.format, on_violation=a.on_violation)
        log = run_increment(spark, raw, a.out_dir, a.run, a.grain, horizons_weeks=horizons, rule_model=a.rule_model)
    else:
        log = run_from_raw_dir(spark, a.raw_dir, a.out_dir, a.format, a.on_violation, a.resume,
                               horizons_weeks=horizons, rule_model=a.rule_model)
    print(json.dumps(log))


if __name__ == "__main__":
    main()
