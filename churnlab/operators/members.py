"""Member-table cleaning."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions import years_between, yyyymmdd_to_date

# Age cap, right-closed age bins and their labels.
AGE_CAP = 80
AGE_BINS = [10, 18, 35, 55, 99]
AGE_LABELS = ["Teenagers", "Young Adult", "Middle Age Adult", "Elderly"]


def members_filled(members: DataFrame, value: str = "other") -> DataFrame:
    """NULLs in string columns become ``value``; other types are untouched."""
    return members.na.fill(value)


def age_capped(df: DataFrame, col: str = "bd", cap: int = AGE_CAP) -> DataFrame:
    """Ages above ``cap`` become 0 and NULL becomes 0; others are kept."""
    c = F.col(col)
    return df.withColumn(col, F.coalesce(F.when(c > cap, F.lit(0)).otherwise(c), F.lit(0)).cast("int"))


def tenure_years(df: DataFrame, as_of: _dt.date, col: str = "registration_init_time",
                 out: str = "tenure") -> DataFrame:
    return df.withColumn(out, years_between(as_of, yyyymmdd_to_date(col)))


def age_group(col: str = "bd") -> F.Column:
    """Labelled right-closed ranges; outside all ranges (or NULL) gives NULL."""
    c = F.col(col)
    expr = None
    for lo, hi, label in zip(AGE_BINS[:-1], AGE_BINS[1:], AGE_LABELS):
        cond = (c > lo) & (c <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def age_groups(df: DataFrame, col: str = "bd", out: str = "age_group") -> DataFrame:
    return df.withColumn(out, age_group(col))


def drop_incomplete(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)
