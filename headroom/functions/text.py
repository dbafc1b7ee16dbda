"""Text helpers for narratives and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fmt_one_decimal(col) -> Column:
    """Value rounded to one decimal, always printed with that decimal ("95.0", "107.6"); missing prints "nan".

    A pattern ``format_number`` rounds the exact binary value (0.15 -> "0.1", 0.35 -> "0.3"),
    as scaling by ten before rounding does not.
    """
    return F.coalesce(F.call_function("format_number", _c(col), F.lit("0.0")), F.lit("nan"))


def rounded_two_decimals(col) -> Column:
    """Value rounded to two decimals on its exact binary value."""
    return F.call_function("format_number", _c(col), F.lit("0.00")).cast("double")


def shortest_text(col) -> Column:
    """Shortest decimal text of a double ("95.0", "107.58")."""
    return _c(col).cast("string")
