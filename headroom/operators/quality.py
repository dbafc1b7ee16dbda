"""Data-quality checks on raw metric tables (V1-V4).

Rules are declarative (name, columns, violation predicate, message) and are all evaluated by
one aggregate of ``count_if`` per rule, so checking a large table is a single pass with
map-side partial aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headroom.schemas import KINDS, MetricKind


class SchemaValidationError(ValueError):
    """A raw table misses required columns or breaks a value rule."""


@dataclass(frozen=True)
class Rule:
    name: str
    violation: Callable[[], Column]
    message: str


# --- fixed values: rule messages -----------------------------------------------------------
CPU_BOUNDS_MESSAGE = "cpu_utilization_pct out of bounds [0, 100]"
USED_GT_TOTAL_MESSAGE = "disk_used_gb cannot exceed disk_total_gb"
NEGATIVE_LATENCY_MESSAGE = "latency_ms cannot be negative"
MISSING_COLUMNS_MESSAGE = "{} is missing required columns: {}"
TABLE_LABELS = {"compute": "compute metrics", "storage": "storage metrics", "network": "network metrics"}
# --- end of fixed values ------------------------------------------------------------------

RULES: dict[str, tuple[Rule, ...]] = {
    "compute": (Rule("cpu_out_of_bounds",
                     lambda: (F.col("cpu_utilization_pct") < 0) | (F.col("cpu_utilization_pct") > 100),
                     CPU_BOUNDS_MESSAGE),),
    "storage": (Rule("used_exceeds_total", lambda: F.col("disk_used_gb") > F.col("disk_total_gb"),
                     USED_GT_TOTAL_MESSAGE),),
    "network": (Rule("negative_latency", lambda: F.col("latency_ms") < 0, NEGATIVE_LATENCY_MESSAGE),),
}

def require_columns(df: DataFrame, expected: Iterable[str], name: str) -> None:
    """V1: fail when required columns are absent; extra columns and column order are fine."""
    absent = sorted(c for c in expected if c not in df.columns)
    if absent:
        raise SchemaValidationError(MISSING_COLUMNS_MESSAGE.format(name, absent))


def violation_counts(df: DataFrame, kind: str | MetricKind) -> DataFrame:
    """One row per rule: (table_name, rule, violations). A missing value never violates."""
    k = KINDS[kind] if isinstance(kind, str) else kind
    rules = RULES[k.name]
    counts = df.agg(*[F.count_if(F.coalesce(r.violation(), F.lit(False))).alias(r.name) for r in rules])
    stack = ", ".join(f"'{r.name}', `{r.name}`" for r in rules)
    return counts.select(F.lit(k.name).alias("table_name"),
                         F.expr(f"stack({len(rules)}, {stack}) as (rule, violations)"))


def check_metrics(df: DataFrame, kind: str | MetricKind) -> DataFrame:
    """V2-V4: raise :class:`SchemaValidationError` on the first broken rule, else return ``df``.

    Runs one small job (a global ``count_if`` aggregate); the input stays lazy.
    """
    k = KINDS[kind] if isinstance(kind, str) else kind
    require_columns(df, k.columns, TABLE_LABELS[k.name])
    rules = RULES[k.name]
    row = df.agg(*[F.count_if(F.coalesce(r.violation(), F.lit(False))).alias(r.name) for r in rules]).first()
    for r in rules:
        if row[r.name]:
            raise SchemaValidationError(r.message)
    return df


def validate_compute(df: DataFrame) -> DataFrame:
    return check_metrics(df, "compute")


def validate_storage(df: DataFrame) -> DataFrame:
    return check_metrics(df, "storage")


def validate_network(df: DataFrame) -> DataFrame:
    return check_metrics(df, "network")


VALIDATORS = {"compute": validate_compute, "storage": validate_storage, "network": validate_network}


def observe_quality(df: DataFrame, kind: str | MetricKind, name: str | None = None):
    """Attach the rule counts to ``df`` as an ``Observation`` filled by whatever job consumes it.

    Returns (observed_df, observation). Checking then costs no extra pass over a large
    table: write the data, then call :func:`raise_on_violations`.
    """
    from pyspark.sql import Observation

    k = KINDS[kind] if isinstance(kind, str) else kind
    require_columns(df, k.columns, TABLE_LABELS[k.name])
    obs = Observation(name or f"quality_{k.name}")
    rules = RULES[k.name]
    # Rows without a timestamp are reported too (they cannot be de-duplicated or dated), but
    # only the rules above can fail a load.
    observed = df.observe(obs, *[F.count_if(F.coalesce(r.violation(), F.lit(False))).alias(r.name) for r in rules],
                          F.count_if(F.col("timestamp").isNull()).alias("missing_timestamp"))
    return observed, obs


def broken(obs, kind: str | MetricKind) -> bool:
    """Whether an observed job found a rule broken."""
    k = KINDS[kind] if isinstance(kind, str) else kind
    counts = obs.get
    return any(counts.get(r.name) for r in RULES[k.name])


def raise_on_violations(obs, kind: str | MetricKind) -> None:
    """Raise :class:`SchemaValidationError` for the first rule an observed job found broken."""
    k = KINDS[kind] if isinstance(kind, str) else kind
    counts = obs.get
    for r in RULES[k.name]:
        if counts.get(r.name):
            raise SchemaValidationError(r.message)
