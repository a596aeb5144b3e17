"""Q3 distribution drift: two-sample distances with thresholds from the sample sizes.

Numeric columns: the Kolmogorov-Smirnov distance, the largest gap between the two
cumulative shares, against ``sqrt(-ln(alpha / 2) / 2) * sqrt((n + m) / (n m))``.
Other columns: the total variation, half the summed gaps between the shares of the
values, against the sum over both samples of ``sqrt((K ln 2 + ln(2 / alpha)) / (2 n))``
with K values seen (a bound on the deviation of a sample's shares in the L1 norm).
Values of both samples are counted per (column, value) once, with map-side combine, so
a frequent value is one row, and running sums go over range slices. NULL and NaN are no
values; a column without values in one of the samples has no distance and is not reported.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions.running import running_totals
from churnlab.operators.prep import present
from churnlab.session import cut_lineage


def value_counts(baseline: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(column, v, value, b, c): rows of each sample with a value, as number or as text."""
    pairs = [F.struct(F.lit(c).alias("column"), present(c).alias("v"), F.lit(None).cast("string").alias("value")) for c in numeric]
    pairs += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("v"), F.col(c).cast("string").alias("value")) for c in categorical]
    own = lambda df, b: df.select(F.explode(F.array(*pairs)).alias("p"), F.lit(b).alias("b"), F.lit(1 - b).alias("c")).select("p.*", "b", "c")
    both = own(baseline, 1).unionByName(own(current, 0)).where("v IS NOT NULL OR value IS NOT NULL")
    return cut_lineage(both.groupBy("column", "v", "value").agg(F.sum("b").alias("b"), F.sum("c").alias("c")), "drift_counts")


def distribution_drift(baseline: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], alpha: float = 0.05) -> DataFrame:
    """(column, check, n_baseline, n_current, distance, threshold, drifted), a row per column
    with values in both samples; ``check`` is ``ks`` or ``tv``."""
    counts = value_counts(baseline, current, numeric, categorical)
    n, m = F.col("n_baseline"), F.col("n_current")
    gap = F.abs(F.try_divide(F.col("cum_b"), F.col("all_b")) - F.try_divide(F.col("cum_c"), F.col("all_c")))
    running = running_totals(counts.where("v IS NOT NULL").select("column", "v", "b", "c"), "v", ["b", "c"], group="column")
    ks = running.groupBy("column").agg(F.max("all_b").alias("n_baseline"), F.max("all_c").alias("n_current"), F.max(gap).alias("distance"))
    ks = ks.withColumns({"check": F.lit("ks"), "threshold": F.lit(math.sqrt(-math.log(alpha / 2) / 2)) * F.sqrt((n + m) / (n * m))})
    texts = counts.where("value IS NOT NULL")
    sizes = texts.groupBy("column").agg(F.sum("b").alias("n_baseline"), F.sum("c").alias("n_current"), F.count(F.lit(1)).alias("k"))
    apart = F.sum(F.abs(F.try_divide(F.col("b"), n) - F.try_divide(F.col("c"), m))) / 2
    tv = (texts.join(F.broadcast(sizes), "column")  # one row a column
          .groupBy("column").agg(F.max("n_baseline").alias("n_baseline"), F.max("n_current").alias("n_current"), F.max("k").alias("k"), apart.alias("distance")))
    bound = sum((F.sqrt((F.col("k") * math.log(2) + math.log(2 / alpha)) / (2 * x)) for x in (n, m)), F.lit(0.0))
    tv = tv.withColumns({"check": F.lit("tv"), "threshold": bound})
    cols = ["column", "check", "n_baseline", "n_current", "distance", "threshold"]
    out = ks.select(cols).unionByName(tv.select(cols)).where("n_baseline > 0 AND n_current > 0")
    return out.withColumn("drifted", F.col("distance") > F.col("threshold"))
