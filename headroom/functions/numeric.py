"""Numeric column helpers with pandas/numpy semantics.

Spark has two "missing" values for doubles (NULL and NaN); the operators here assume NaN
has been turned into NULL at the source (:func:`nan_to_null`), so only NULL remains.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def pos_inf() -> Column:
    return F.lit(float("inf"))


def neg_inf() -> Column:
    return F.lit(float("-inf"))


def null_double() -> Column:
    return F.lit(None).cast("double")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    """NaN -> NULL, everything else unchanged."""
    return F.nanvl(_c(col), null_double())


def clip(col, lower: float | None = None, upper: float | None = None) -> Column:
    """Clamp into [lower, upper]; a missing value stays missing (unlike least/greatest)."""
    c = _c(col)
    out = F.when(c.isNull() | F.isnan(c), c)
    if lower is not None:
        out = out.when(c < F.lit(float(lower)), F.lit(float(lower)))
    if upper is not None:
        out = out.when(c > F.lit(float(upper)), F.lit(float(upper)))
    return out.otherwise(c)


def pandas_div(num, den) -> Column:
    """num / den with float semantics instead of ANSI errors: x/0 -> +-inf, 0/0 -> missing."""
    n, d = _c(num), _c(den)
    return (F.when(n.isNull() | d.isNull(), null_double())
            .when(d == 0, F.when(n > 0, pos_inf()).when(n < 0, neg_inf()).otherwise(null_double()))
            .otherwise(n.cast("double") / d))


def round_half_even(col, decimals: int) -> Column:
    """numpy's ``round``: rint(x * 10**d) / 10**d (ties to even on the scaled binary value)."""
    scale = float(10 ** decimals)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


def round_to(col, decimals: int) -> Column:
    """Stable rounding for comparisons across engines (same formula as DuckDB's round_even)."""
    return round_half_even(col, decimals)


def packed_order(*parts: tuple) -> Column:
    """One decimal that sorts like the tuple of ``(column, digits)`` parts, NULL before every value.

    Each part is a whole number from 0 to 10**digits - 2; the digits together are 38 at most. As an
    order column it keeps ``min_by`` in a hash aggregate, which a struct would not. A value that
    needs more digits fails (ANSI mode) instead of spoiling the order.
    """
    if sum(d for _, d in parts) > 38:
        raise ValueError("the parts need more than 38 digits")
    out = None
    for col, digits in parts:
        c = F.coalesce(_c(col).cast("long") + F.lit(1), F.lit(0)).cast(f"decimal({digits},0)")
        out = c if out is None else out * F.lit(Decimal(10 ** digits)) + c
    return out.cast("decimal(38,0)")
