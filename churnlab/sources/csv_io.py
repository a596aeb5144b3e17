"""S1-S6 CSV import/export with explicit schemas (no inference pass).

Exports keep the frame's partitioning (one file per task, no ``coalesce(1)``
funnel through a single task); ``maxRecordsPerFile`` bounds file size.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from churnlab.session import checkpoint_dir


def export_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder on shared storage: ``churnlab.output.dir`` if configured,
    else under the cluster's checkpoint folder (never a machine-local temp)."""
    base = spark.conf.get("churnlab.output.dir", None) or os.path.join(checkpoint_dir(spark), "exports")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def write_csv(df: DataFrame, path: str, header: bool = True, max_records_per_file: int = 5_000_000) -> str:
    (df.write.mode("overwrite").option("header", header)
       .option("maxRecordsPerFile", max_records_per_file).csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Header or headerless CSV; all part files of the folder are read (not just
    the first). Without a header, columns are named by ``schema`` position. With
    one, its names must be the schema's, in order: a file whose columns stand
    otherwise fails, and is not read under wrong names."""
    return (spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
            .option("enforceSchema", not header).csv(path))
