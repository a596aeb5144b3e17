"""Division that never raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio_or_zero(num, den) -> Column:
    """Library convention for precision/recall/F1: zero denominator gives 0."""
    return F.coalesce(ratio(num, den), F.lit(0.0))
