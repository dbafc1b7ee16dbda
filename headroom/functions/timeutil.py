"""Time-zone independent helpers for naive (``timestamp_ntz``) event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def floor_hour_ntz(col) -> Column:
    """Truncate a naive timestamp to the hour without going through the session time zone."""
    c = _c(col)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def ntz_as_utc_instant(col) -> Column:
    """Read a naive timestamp as a UTC instant (``timestamp``), e.g. for watermarks and windows.

    Built from date arithmetic so the session time zone plays no part; sub-second digits are
    dropped, which never moves an event across an hour or day boundary.
    """
    c = _c(col)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    secs = days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.timestamp_seconds(secs)


def epoch_day_to_date(instant) -> Column:
    """Calendar date (UTC) of a ``timestamp`` instant, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_c(instant)) / F.lit(86400)).cast("int"))
