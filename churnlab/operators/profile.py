"""Distributions, null audits, missing shares, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.session import cut_lineage


def value_counts(df: DataFrame, col, name: str | None = None) -> DataFrame:
    """(value, n, share): frequency table, most frequent first (ties by value),
    with each value's share of all rows. One scan: the total is the sum of the
    counts, which are written out before they are read twice."""
    c = F.col(col) if isinstance(col, str) else col
    name = name or (col if isinstance(col, str) else "value")
    counts = cut_lineage(df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("n")), "value_counts")
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), F.col(name).asc_nulls_first())


def null_audit(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """(by, feature, n_null) for every column in ONE aggregate (per group),
    instead of one filter+count job per column and split."""
    keys = [by] if by else []
    wide = df.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("n_null")) for i, c in enumerate(cols)])
    return wide.select(*keys, F.inline(rows))


def missing_pct(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, pct_missing) rounded to 2 places, one aggregate."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"),
                              F.round(F.col(f"_{i}") / F.col("_n") * 100, 2).alias("pct_missing"))
                     for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def top_n(df: DataFrame, by: str, n: int, tiebreak: str) -> DataFrame:
    """Deterministic preview: the n largest ``by`` values (ties by ``tiebreak``).
    Spark plans this as TakeOrderedAndProject: a per-partition top-n, no full sort."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tiebreak).asc()).limit(n)
