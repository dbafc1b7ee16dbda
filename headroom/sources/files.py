"""File sources and sinks.

Files are matched by column name: the header (or the file's own schema) says where each column
is, a missing required column fails, extra columns are dropped. Types are explicit, never
inferred; every double is NaN-normalised to NULL at the source so later operators see a
single missing value. Writes go through ``DataFrame.write``
and report the row count through an ``Observation`` filled by the same job.
"""

from __future__ import annotations

import logging
import uuid
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headroom.functions.numeric import nan_to_null, packed_order
from headroom.operators.cleaning import CLEANERS, SEQ
from headroom.operators.quality import TABLE_LABELS, VALIDATORS, require_columns, violation_counts
from headroom.operators.trends import TREND_BUILDERS
from headroom.operators.series import prepare_all
from headroom.schemas import KINDS

logger = logging.getLogger(__name__)

#: Means, growth rates and forecasts are doubles of which the session's default (snappy) hardly takes anything off.
PARQUET_CODEC = "zstd"

RAW_FILES = {"compute": "compute_metrics", "storage": "storage_metrics", "network": "network_metrics"}


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN -> NULL on every double/float column."""
    cols = {f.name: nan_to_null(f.name) for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(cols) if cols else df


_PATH, _MODIFIED, _BLOCK = "_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_block_start"
#: Digits of an input order: file, block, row.
_FILE_DIGITS, _BLOCK_DIGITS, _ROW_DIGITS = 6, 13, 19


def file_ordinals(spark: SparkSession, path: str, by: str = "path") -> DataFrame:
    """``_file, _ordinal``: the files at ``path`` numbered by their path, or by landing (modification
    time, then path). Only the listing is read; like Spark's own, it passes through the driver."""
    if by not in ("path", "landed"):
        raise ValueError("by must be 'path' or 'landed'")
    listed = spark.read.format("binaryFile").load(path).select(F.col(_PATH).alias("path"), F.col(_MODIFIED).alias("at")).collect()
    order = sorted(listed, key=lambda r: (r["at"], r["path"]) if by == "landed" else r["path"])
    return spark.createDataFrame([(r["path"], i) for i, r in enumerate(order)], "_file string, _ordinal int")


def with_input_order(df: DataFrame, ordinals: DataFrame, file: str = _PATH, block: str = _BLOCK) -> DataFrame:
    """Attach ``seq``, the input order (file, block start, row) packed into one decimal.

    ``df`` is a file scan, or rows that carry the scan's path and block as columns, in the
    order of the file; a fixed-width order keeps de-duplication in a hash aggregate.
    """
    placed = df.withColumns({"_path": F.col(file), "_block": F.col(block), "_row": F.monotonically_increasing_id()})
    placed = placed.join(ordinals, placed["_path"] == ordinals["_file"], "left")
    seq = packed_order(("_ordinal", _FILE_DIGITS), ("_block", _BLOCK_DIGITS), ("_row", _ROW_DIGITS))
    return placed.withColumn(SEQ, seq).drop("_path", "_block", "_row", "_file", "_ordinal")


def file_schema(spark: SparkSession, path: str, fmt: str, wanted: T.StructType, label: str) -> T.StructType:
    """The read schema of the files at ``path``: V1 on the columns they really have, then the wanted
    type for each wanted column, wherever it stands.

    For CSV only the first line is read. The columns keep their place in the file, and every
    other column is text that no one selects; with ``enforceSchema=false`` a file of the folder
    whose header differs fails when it is read.
    """
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    found = reader.format(fmt).load(path)
    require_columns(found, wanted.names, label)
    if fmt != "csv":  # formats with names in the file are read by name
        return wanted
    types = {f.name: f for f in wanted.fields}
    return T.StructType([types.get(c, T.StructField(c, T.StringType(), True)) for c in found.columns])


def read_metrics(spark: SparkSession, path: str, kind: str, fmt: str = "csv",
                 validator: Callable[[DataFrame], DataFrame] | None = None,
                 on_violation: str = "fail", order: str = "path") -> DataFrame:
    """Read a raw metric table by column name, NaN->NULL, input order, then validate.

    Column order in the file does not matter and extra columns are dropped; a file without a
    required column raises :class:`SchemaValidationError`, whatever ``on_violation`` says.

    ``on_violation="fail"`` raises like the source on a broken rule; ``"report"`` leaves
    repair to the cleaners (use :func:`violation_counts` to see what would fail). Of repeated
    rows in several files the first counts, by ``order`` of the files' paths or as they "landed".
    """
    k = KINDS[kind]
    reader = spark.read.schema(file_schema(spark, path, fmt, k.schema, TABLE_LABELS[kind])).format(fmt)
    if fmt == "csv":
        # Spark's default timestamp parsing accepts "2025-01-01 00:00:00", "2025-01-01T00:00:00.000"
        # (Spark's own CSV output) and date-only values.
        reader = reader.option("header", True).option("enforceSchema", False)
    df = with_input_order(reader.load(path), file_ordinals(spark, path, order))
    df = normalise_missing(df.select(*k.columns, SEQ))
    if on_violation == "fail":
        (validator or VALIDATORS[kind])(df)
    elif on_violation != "report":
        raise ValueError("on_violation must be 'fail' or 'report'")
    return df


def read_all(spark: SparkSession, raw_dir: str, fmt: str = "csv", on_violation: str = "fail") -> dict[str, DataFrame]:
    """The three raw tables under ``raw_dir``."""
    ext = "csv" if fmt == "csv" else fmt
    return {kind: read_metrics(spark, f"{raw_dir}/{name}.{ext}", kind, fmt, on_violation=on_violation)
            for kind, name in RAW_FILES.items()}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, label: str | None = None, rows_per_file: int = 0,
                compression: str | None = None) -> tuple[str, int]:
    """Write ``df`` and return (path, rows) from an Observation of the same job; logs
    ``[SAVED] <label>: <rows> rows -> <path>``. ``compression`` is the codec (Parquet: PARQUET_CODEC,
    text: none unless given; compressed text files are named for it, as ``.csv.gz``)."""
    obs = Observation(f"rows_{abs(hash(path))}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression := compression or (PARQUET_CODEC if fmt == "parquet" else None):
        w = w.option("compression", compression)
    if fmt == "csv":
        w.option("header", True).option("escape", "\"").csv(path)
    else:
        w.format(fmt).save(path)
    rows = int(obs.get["rows"])
    logger.info("[SAVED] %s: %s rows -> %s", label or path.rstrip("/").rsplit("/", 1)[-1], f"{rows:,}", path)
    return path, rows


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet", files: int | None = None,
                 rows_per_file: int = 0, label: str | None = None, compression: str | None = None) -> tuple[str, int]:
    """L1 at a sink: S5 in the order of ``keys`` (id, then time), as sorted files whose ranges don't overlap.

    Range bounds over all keys split a hot id by its time, so files stay of one size; a reader's
    filter on an id finds its row groups by their statistics. The bounds are drawn from a sample of
    ``df``, which Spark computes for that: give a written table, not a plan that is dear to run twice.
    ``files`` fixes their number (default: AQE's, from the size), ``rows_per_file`` bounds it (0: no bound).
    """
    order = [F.col(k).asc_nulls_last() for k in keys]
    placed = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return write_table(placed.sortWithinPartitions(*order), path, fmt, label=label, rows_per_file=rows_per_file, compression=compression)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """``df`` written in buckets of ``keys``, sorted within, and read again as a table.

    Tables with the same keys and number of buckets join and group by resource without an exchange.
    Bucketing is known to the session's catalog only, so the table gets a name of its own there;
    the files at ``path`` are plain parquet for any other reader.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    w = df.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *keys)
    w.sortBy(*keys, *order).saveAsTable(name)
    return df.sparkSession.table(name)


def write_interim(datasets: Mapping[str, DataFrame], interim_dir: str) -> dict[str, tuple[str, int]]:
    """S3: each ingested table as ``<name>_ingested`` (parquet)."""
    return {name: write_table(df, f"{interim_dir}/{name}_ingested") for name, df in datasets.items()}


def clean_all(spark: SparkSession, interim_dir: str, processed_dir: str) -> dict[str, DataFrame]:
    """Read interim, clean, write ``<name>_cleaned``; returns the cleaned tables re-read from disk."""
    out = {}
    for name, cleaner in CLEANERS.items():
        cleaned = cleaner(spark.read.parquet(f"{interim_dir}/{name}_ingested"))
        path, _ = write_table(cleaned, f"{processed_dir}/{name}_cleaned")
        out[name] = spark.read.parquet(path)
    return out


def write_trends(spark: SparkSession, processed_dir: str) -> dict[str, DataFrame]:
    """Cleaned tables -> trend tables ``<name>_trends``."""
    out = {}
    for name, build in TREND_BUILDERS.items():
        path, _ = write_table(build(spark.read.parquet(f"{processed_dir}/{name}_cleaned")),
                              f"{processed_dir}/{name}_trends")
        out[name] = spark.read.parquet(path)
    return out


def load_series(spark: SparkSession, processed_dir: str) -> DataFrame:
    """The three trend tables as one long series table."""
    return prepare_all({name: spark.read.parquet(f"{processed_dir}/{name}_trends") for name in TREND_BUILDERS})


def land_recommendations(recs: DataFrame, path: str, fmt: str = "csv") -> tuple[str, int]:
    """Persist recommendations; ``details`` becomes JSON text (CSV cannot hold a map)."""
    flat = recs.withColumn("details", F.to_json("details")) if fmt == "csv" else recs
    return write_table(flat, path, fmt)


def dq_report(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Violation counts of all raw tables in one table."""
    frames = [violation_counts(df, kind) for kind, df in raw.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
