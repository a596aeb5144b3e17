"""F4 listening-log features: per-user means, seconds on a log scale.

``ln`` of a non-positive value is NULL and drops out of the mean (Spark's rule),
instead of poisoning it with -inf.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.schemas import LOG_COLUMNS


def log_means(logs: DataFrame) -> DataFrame:
    secs = F.col("total_secs")
    logged = logs.withColumn("total_secs", F.when(secs > 0, F.ln(secs)))
    return logged.groupBy("msno").agg(*[F.avg(c).alias(c) for c in LOG_COLUMNS])
