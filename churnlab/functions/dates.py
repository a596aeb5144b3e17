"""Integer ``yyyyMMdd`` dates, as the subscription data stores them."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yyyymmdd_to_date(c) -> Column:
    """Parse an int/str ``yyyyMMdd``; malformed or NULL input gives NULL (never throws)."""
    return F.try_to_date(_col(c).cast("string"), "yyyyMMdd")


def date_to_yyyymmdd(c) -> Column:
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def years_between(end: _dt.date | str, start) -> Column:
    """``datediff(end, start) / 365`` as a double (the reference's tenure rule)."""
    end_lit = F.lit(end if isinstance(end, _dt.date) else _dt.date.fromisoformat(end))
    return F.datediff(end_lit, _col(start)) / F.lit(365.0)


def iso_utc(c) -> Column:
    """ISO-8601 text with milliseconds and ``Z`` for a UTC wall-clock
    ``TIMESTAMP_NTZ`` (the feature-record event-time format); no session
    time zone is involved."""
    return F.date_format(_col(c).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
