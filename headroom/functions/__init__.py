"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from headroom.functions.numeric import (
    clip, nan_to_null, pandas_div, round_half_even, round_to,
)
from headroom.functions.timeutil import epoch_day_to_date, floor_hour_ntz, ntz_as_utc_instant
from headroom.functions.text import fmt_one_decimal, shortest_text

__all__ = [
    "clip", "nan_to_null", "pandas_div", "round_half_even", "round_to",
    "epoch_day_to_date", "floor_hour_ntz", "ntz_as_utc_instant", "fmt_one_decimal", "shortest_text",
]
