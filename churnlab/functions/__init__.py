"""Column-level helpers; all are built-in Spark expressions (codegen, no Python UDF)."""

from churnlab.functions.dates import date_to_yyyymmdd, iso_utc, yyyymmdd_to_date, years_between
from churnlab.functions.hashing import hash_bucket, hash_unit
from churnlab.functions.safe import ratio, ratio_or_zero

__all__ = [
    "date_to_yyyymmdd", "iso_utc", "yyyymmdd_to_date", "years_between",
    "hash_bucket", "hash_unit", "ratio", "ratio_or_zero",
]
