"""Nightly increments (E1): date-partitioned tables that take new and late rows without a full run.

A :class:`DayStore` holds one kind of metric as four tables, all written by dynamic partition
overwrite, so a run that stopped half-way is simply run again under its number:

``first/period=/run=`` first-wins rows as landed (before cleaning: a missing first copy evicts
                       a later one). Rows whose (timestamp, id) an earlier run already has lose.
``rollup/period=/run=`` each run's cleaned rows as (sum, count) per (id, day). A day's means are
                       the merged rollups of its runs, so late rows never re-read raw rows.
``trends/period=``     daily means with their indicators.
``tails/as_of=/run=``  what the indicators after a day need: each resource's last 30 daily rows
                       and, if those are all missing, its last present value. A run leaves them
                       for the newest day and for days ever further back (1, 3, 7, 15, ...).

A run reads its own rows, the keys of the days that they touch, the newest tails before the
first of those days, and the rollups after them: the trends are rebuilt from the first touched
day on, which is the new day alone on a normal night, and nothing is read from more than twice
as far back. The log ``runs`` (one row a run) says which tails later late rows have made stale.

A period is a day, or a month or year where a day has few rows (``grain``). Which days a run touches is
collected (one value a day); everything else stays in Spark. Days are written with a
``rebalance`` hint: one larger than the advisory partition size is written by several tasks,
small ones share a task. Months and years are few, so each task writes its part of each, by id and
time (which keeps files and later shuffles small), and no row is shuffled for that.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.operators.cleaning import SEQ, dedupe_first
from headroom.operators.trends import add_trend_indicators, merge_rollups, rollup_daily, rollup_means
from headroom.schemas import KINDS, MetricKind
from headroom.streaming.landing import row_clean

# Rows of history an indicator looks back on (the longest moving average), the current one included.
HISTORY_ROWS = 30


def _overwrite_partitions(df: DataFrame, path: str, *partitions: str, order: tuple[str, ...] | None = None) -> None:
    """Replace the partitions that ``df`` has rows for, and no others. Given an ``order``, each task writes
    its part of every partition in it, without a shuffle."""
    placed = df.sortWithinPartitions(*partitions, *order) if order else df.hint("rebalance", *[F.col(p) for p in partitions])
    (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(*partitions).parquet(path))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` (empty before its first run), with partition columns of the stated type."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).where(F.lit(False))  # so that the optimizer knows that it is empty


@dataclass(frozen=True)
class Touched:
    """The days a run touches, and their periods."""

    days: tuple[dt.date, ...]
    periods: tuple[dt.date, ...]
    undated: bool  # some rows have no timestamp

    def among(self, column: str) -> Column:
        hit = F.col(column).isin(list(self.periods))
        return (hit | F.col(column).isNull()) if self.undated else hit


class DayStore:
    """Incremental cleaning and trends of one metric kind in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, kind: str | MetricKind, fill: str = "ffill", grain: str = "day"):
        if grain not in ("day", "month", "year"):
            raise ValueError(f"grain must be 'day', 'month' or 'year', got {grain!r}")
        self.spark, self.path, self.fill, self.grain = spark, path.rstrip("/"), fill, grain
        self.kind = KINDS[kind] if isinstance(kind, str) else kind
        k = self.kind
        day, period, number = T.StructField("date", T.DateType()), T.StructField("period", T.DateType()), T.StructField("run", T.LongType())
        parts = [T.StructField(f"{c}_{p}", t) for c in k.daily_cols for p, t in (("sum", T.DoubleType()), ("count", T.LongType()))]
        who = k.schema[k.id_col]
        self._first = T.StructType([*k.schema.fields, period, number])
        self._rollup = T.StructType([who, day, *parts, period, number])
        values = [T.StructField(c, T.DoubleType()) for c in k.daily_cols]
        self._trends = T.StructType([who, *values, *[T.StructField(f"{k.target}_{n}", T.DoubleType()) for n in ("ma7", "ma30", "growth_rate")], day, period])
        self._tails = T.StructType([who, T.StructField(k.target, T.DoubleType()), day, T.StructField("as_of", T.DateType()), number])
        self._runs = T.StructType([T.StructField("min_day", T.DateType()), T.StructField("max_day", T.DateType()),
                                   T.StructField("tail_days", T.ArrayType(T.DateType())), number])

    # ---- tables ----
    def first(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/first", self._first)

    def rollups(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/rollup", self._rollup)

    def runs(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/runs", self._runs)

    def trends(self) -> DataFrame:
        """The trend table as a full run would give it."""
        t = _read(self.spark, f"{self.path}/trends", self._trends)
        return t.select(self.kind.id_col, "date", *[c for c in t.columns if c not in (self.kind.id_col, "date", "period")])

    def period(self, day: dt.date) -> dt.date:
        return {"day": day, "month": day.replace(day=1), "year": day.replace(month=1, day=1)}[self.grain]

    def _period(self, column: str) -> Column:
        return F.col(column) if self.grain == "day" else F.trunc(column, self.grain)

    def _order(self, time: str) -> tuple[str, ...] | None:
        """The order of rows within a period that each task writes its own part of; none for days, which are gathered."""
        return None if self.grain == "day" else (self.kind.id_col, time)

    def cleaned(self) -> DataFrame:
        """All cleaned rows (C7-C9 over every run)."""
        return row_clean(self.first().select(*self.kind.columns), self.kind)

    def daily(self, after: dt.date | None = None) -> DataFrame:
        """A1: daily means, from the rollups after a day only if one is given."""
        k = self.kind
        return rollup_means(merge_rollups(self._rollups_after(after), k.id_col, k.daily_cols), k.id_col, k.daily_cols)

    def _rollups_after(self, after: dt.date | None) -> DataFrame:
        r = self.rollups()
        return r if after is None else r.where((F.col("period") >= F.lit(self.period(after))) & (F.col("date") > F.lit(after)))

    # ---- one run ----
    def add(self, raw: DataFrame, run: int, order_col: str = SEQ) -> Touched:
        """Take the rows of one run. Runs are numbered upwards; repeating a number replaces that
        run (with the same rows, after a failure)."""
        k = self.kind
        own = dedupe_first(raw.select(*k.columns, order_col), k.dedupe_keys, order_col)
        own = own.select(*k.columns).withColumn("date", F.to_date("timestamp")).withColumn("period", self._period("date")).drop("date")
        staged = f"{self.path}/staged/run={run}"
        own.write.mode("overwrite").parquet(staged)
        own = self.spark.read.schema(T.StructType(self._first.fields[:-1])).parquet(staged)
        found = [r["date"] for r in own.select(F.to_date("timestamp").alias("date")).distinct().collect()]  # one value a day
        days = tuple(sorted(d for d in found if d is not None))
        touched = Touched(days, tuple(sorted({self.period(d) for d in days})), None in found)
        if not found:
            return touched
        _overwrite_partitions(self.new_rows(own, touched, run), f"{self.path}/first", "period", "run", order=self._order("timestamp"))
        if touched.days:
            _overwrite_partitions(self.own_rollup(touched, run), f"{self.path}/rollup", "period", "run", order=self._order("date"))
            # A partition is written whole: the trends start with the first touched period.
            tail_days = self._rebuild(touched.periods[0], run)
            log = [(touched.days[0], touched.days[-1], tail_days, run)]
            _overwrite_partitions(self.spark.createDataFrame(log, self._runs), f"{self.path}/runs", "run")
        return touched

    def new_rows(self, own: DataFrame, touched: Touched, run: int) -> DataFrame:
        """The rows whose key no earlier run has; of earlier runs only the touched days' keys are read."""
        k = self.kind
        known = (self.first().where(touched.among("period") & (F.col("run") < run))
                 .select(F.col("timestamp").alias("_at"), F.col(k.id_col).alias("_id")))
        same = own["timestamp"].eqNullSafe(known["_at"]) & own[k.id_col].eqNullSafe(known["_id"])
        return own.join(known, same, "left_anti").withColumn("run", F.lit(run).cast("long"))

    def own_rollup(self, touched: Touched, run: int) -> DataFrame:
        """This run's rollup: its own partitions of the touched days, cleaned and summed."""
        rows = self.first().where(F.col("period").isin(list(touched.periods)) & (F.col("run") == run))
        own = row_clean(rows.select(*self.kind.columns), self.kind)
        return (rollup_daily(own, self.kind.id_col, self.kind.daily_cols)
                .withColumns({"period": self._period("date"), "run": F.lit(run).cast("long")}))

    def _newest_tails(self, before: dt.date, run: int) -> tuple[dt.date, int] | None:
        """The newest tails of a day before ``before`` that no later run has made stale."""
        log = self.runs().where(F.col("run") < run).collect()  # one row a run
        good = [(day, r["run"]) for r in log for day in r["tail_days"]
                if day < before and not any(x["run"] > r["run"] and x["min_day"] <= day for x in log)]
        return max(good, default=None)

    def _parts(self, base: tuple[dt.date, int] | None) -> DataFrame:
        """The rollups after the tails ``base`` and these tails as rollups of one value a day; all rollups without tails."""
        k = self.kind
        rollups = self._rollups_after(None if base is None else base[0]).select([f.name for f in self._rollup.fields[:-2]])
        if base is None:
            return rollups
        tails = _read(self.spark, f"{self.path}/tails", self._tails).where((F.col("as_of") == F.lit(base[0])) & (F.col("run") == base[1]))
        value = F.col(k.target)
        return rollups.unionByName(tails.select(k.id_col, "date", value.alias(f"{k.target}_sum"), value.isNotNull().cast("long").alias(f"{k.target}_count")),
                                   allowMissingColumns=True)

    def history(self, first_day: dt.date, run: int) -> DataFrame:
        """What the trends from ``first_day`` on are made of: id, date, daily columns (missing but for the target in the tail).

        Dealt by the resource, so that the days merge and the indicators look back on them in one exchange."""
        k = self.kind
        parts = self._parts(self._newest_tails(first_day, run)).repartition(k.id_col)
        return rollup_means(merge_rollups(parts, k.id_col, k.daily_cols), k.id_col, k.daily_cols)

    def _rebuild(self, first_day: dt.date, run: int) -> list[dt.date]:
        """Trends from ``first_day`` on, and tails after the newest day and some days before it; returns those days."""
        k = self.kind
        history = self.history(first_day, run)
        trends = add_trend_indicators(history, k.id_col, k.target, fill=self.fill).where(F.col("date") >= F.lit(first_day))
        _overwrite_partitions(trends.withColumn("period", self._period("date")).select([f.name for f in self._trends]),
                              f"{self.path}/trends", "period", order=self._order("date"))
        base = self._newest_tails(first_day, run)
        ends = self._parts(base).agg(F.min("date").alias("low"), F.max("date").alias("high")).first()
        if ends["high"] is None:  # no row of any day was left by cleaning
            return []
        low, days = ends["low"] if base is None else base[0], []
        while not days or days[-1] > low:
            days.append(ends["high"] - dt.timedelta(days=2 ** len(days) - 1))
        days = [d for d in days if d >= low]
        _overwrite_partitions(self.tails(history, days).withColumn("run", F.lit(run).cast("long")).select([f.name for f in self._tails]),
                              f"{self.path}/tails", "as_of", "run", order=self._order("date"))
        return days

    def tails(self, history: DataFrame, days: list[dt.date]) -> DataFrame:
        """After each of some days and per resource, the last 30 daily rows and the last present value, if it is older.

        One pass over the history: a row is in the tail of each day from its own on until 30 rows
        have followed it, and while no present value has, if its own is one."""
        k = self.kind
        latest = Window.partitionBy(k.id_col).orderBy(F.col("date").desc())
        present = F.when(F.col(k.target).isNotNull(), F.col("date"))
        rows = history.select(k.id_col, "date", k.target).withColumns({
            "_out": F.lag("date", HISTORY_ROWS).over(latest),
            "_next": F.last(present, ignorenulls=True).over(latest.rowsBetween(Window.unboundedPreceding, -1))})
        later = lambda c, d: F.col(c).isNull() | (F.col(c) > d)
        holds = lambda d: (F.col("date") <= d) & (later("_out", d) | (F.col(k.target).isNotNull() & later("_next", d)))
        return (rows.withColumn("as_of", F.explode(F.filter(F.array(*[F.lit(d) for d in days]), holds)))
                .select(k.id_col, "date", k.target, "as_of"))


def landings(raw: DataFrame, kind: str | MetricKind) -> list[DataFrame]:
    """A raw table as three nightly landings: the days up to the middle, the days after it with a
    repetition of some rows that have landed, and late rows of the early days (all copies of a key
    land together, so that the first copy is the same as in a full run)."""
    k = KINDS[kind] if isinstance(kind, str) else kind
    ends = raw.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).first()
    if ends["low"] is None:
        return [raw]
    middle = F.lit(ends["low"] + (ends["high"] - ends["low"]) * 0.8)
    share = F.pmod(F.xxhash64("timestamp", k.id_col), F.lit(10))
    early = F.coalesce(F.col("timestamp") <= middle, F.lit(True))
    return [raw.where(early & (share != 0)), raw.where(~early | (early & (share == 1))), raw.where(early & (share == 0))]


def incremental_trends(spark: SparkSession, path: str, raw: DataFrame, kind: str | MetricKind, grain: str = "year") -> DataFrame:
    """The trend table after a :class:`DayStore` at ``path`` took ``raw`` in three landings."""
    store = DayStore(spark, path, kind, grain=grain)
    for run, rows in enumerate(landings(raw, kind)):
        store.add(rows, run)
    return store.trends()
