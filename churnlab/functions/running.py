"""Distributed running sums along an order key.

A global ``Window.orderBy`` runs on ONE partition. Instead the rows are
range-partitioned on (group, key); each range partition is a slice, so there
are as many slices as the shuffle has partitions, sized by the data and not by
a constant. A slice is a window partition of its own, and the totals of the
slices before it are added. The placed rows are written out once, since both the
local sums and the totals must see the same slices. Input rows must be unique
on (group, key): aggregate by key first, which also keeps a hot key to a single
row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlab.session import cut_lineage


def running_totals(df: DataFrame, key: str, sum_cols: list[str], group: str | None = None,
                   slices: int | None = None, prefix: str = "cum_", total_prefix: str = "all_") -> DataFrame:
    """Add ``prefix + c`` = sum of ``c`` over rows of the same group with key <=
    this key, and ``total_prefix + c`` = its sum over the group. ``slices`` fixes
    the number of slices (by default the session's shuffle partitions)."""
    parts = [group] if group else []
    order = [*parts, key]
    placed = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    placed = cut_lineage(placed.withColumn("_slice", F.spark_partition_id()), "running")
    local_w = Window.partitionBy(*parts, "_slice").orderBy(F.col(key)).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"_loc_{c}": F.sum(c).over(local_w) for c in sum_cols})
    # One row per (group, slice): as many as shuffle partitions, and one more for each group.
    totals = placed.groupBy(*parts, "_slice").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    whole = Window.partitionBy(*parts)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, "_slice", *[
        F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols], *[
        F.sum(f"_tot_{c}").over(whole).alias(f"{total_prefix}{c}") for c in sum_cols])
    out = local.join(offsets, on=[*parts, "_slice"], how="inner")
    out = out.withColumns({f"{prefix}{c}": F.col(f"_loc_{c}") + F.col(f"_off_{c}") for c in sum_cols})
    return out.drop("_slice", *[f"_loc_{c}" for c in sum_cols], *[f"_off_{c}" for c in sum_cols])
