"""Drift monitoring on a stream: each micro-batch is profiled and checked
against a training baseline with the same DataFrame operators as the batch
check (Q1-Q3), via ``foreachBatch``.

Violations are written partitioned by epoch with dynamic partition overwrite,
so a batch replayed after a failure replaces its own output instead of
duplicating it (the stream checkpoint makes the replay exactly-once).

``sketch_monitor`` checks by event time instead: windows with a watermark, whose
merged sketches are the state that lives across micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnlab.operators.quality import drift_violations, profile_table
from churnlab.operators.sketches import SCHEMA, merged_profile, sketch_rows


def drift_monitor(stream: DataFrame, baseline_profile: DataFrame, cols: list[str], sink_path: str,
                  checkpoint_location: str, available_now: bool = True,
                  processing_time: str | None = None, mean_shift_stds: float = 1.0) -> StreamingQuery:
    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        cur = profile_table(batch, cols)
        v = drift_violations(baseline_profile, cur, mean_shift_stds).withColumn("epoch_id", F.lit(epoch_id))
        (v.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("epoch_id").parquet(sink_path))

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# ------------------------------------------------------------ event-time windows
def sketch_windows(stream: DataFrame, time: str, cols: list[str], width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Rows of ``sketches.SCHEMA`` for each event-time window, ``part`` being its first
    moment. On a stream the aggregate's state holds the windows' sketches and merges each
    micro-batch into them; ``delay`` behind the latest event a window is closed and its
    state dropped, and rows that come for it later are left out."""
    own = stream.select(F.col(time).cast("timestamp").alias("_time"), *cols).withWatermark("_time", delay)
    started = own.withColumn("_window", F.window("_time", width))
    return sketch_rows(started, F.date_format("_window.start", "yyyy-MM-dd HH:mm:ss"), cols, group=F.col("_window"))


def sketch_monitor(stream: DataFrame, time: str, cols: list[str], sink_path: str, checkpoint_location: str, width: str = "1 day",
                   delay: str = "1 day", available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Keep the sketches of event-time windows up to date under ``sink_path``: each trigger
    writes the windows that it has changed as its epoch, in place of what an earlier try
    of that epoch has left."""
    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("epoch_id", F.lit(epoch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch_id").parquet(sink_path))

    writer = (sketch_windows(stream, time, cols, width, delay).writeStream.outputMode("update")
              .foreachBatch(on_batch).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def window_sketches(spark: SparkSession, sink_path: str) -> DataFrame:
    """The latest sketches of every window: rows of ``sketches.SCHEMA``."""
    rows = spark.read.schema(f"{SCHEMA}, epoch_id long").parquet(sink_path)
    names = [f.name for f in rows.schema.fields if f.name != "epoch_id"]
    last = rows.groupBy("part", "column").agg(F.max_by(F.struct(*names), "epoch_id").alias("r"))
    return last.select("r.*")


def window_profiles(spark: SparkSession, sink_path: str) -> DataFrame:
    """``part`` and the profile of each column in each window."""
    rows = window_sketches(spark, sink_path)
    named = rows.withColumn("column", F.concat_ws("\u0000", "part", "column"))  # a window's column is a column of its own
    both = F.split("column", "\u0000")
    return merged_profile(named).withColumns({"part": both[0], "column": both[1]})


def window_violations(profiles: DataFrame, baseline: DataFrame, mean_shift_stds: float = 1.0) -> DataFrame:
    """(part, column, check, baseline_value, observed_value): windows whose completeness
    fell below the baseline profile's, that hold negative values where it had none, or whose
    mean is off by more than ``mean_shift_stds`` of its deviations."""
    share = lambda n, missing: F.try_divide(F.col(n) - F.col(missing), F.col(n))
    base = baseline.select("column", share("n", "n_missing").alias("b_share"), F.col("mean").alias("b_mean"), F.col("std").alias("b_std"), F.col("min").alias("b_min"))
    rows = profiles.join(F.broadcast(base), "column")  # one row a column
    checks = F.array(
        F.struct(F.lit("completeness").alias("check"), F.col("b_share").alias("baseline_value"), share("n", "n_missing").alias("observed_value"),
                 (share("n", "n_missing") < F.col("b_share")).alias("bad")),
        F.struct(F.lit("non_negative").alias("check"), F.lit(0.0).alias("baseline_value"), F.col("min").alias("observed_value"),
                 ((F.col("b_min") >= 0) & (F.col("min") < 0)).alias("bad")),
        F.struct(F.lit("mean_shift").alias("check"), F.col("b_mean").alias("baseline_value"), F.col("mean").alias("observed_value"),
                 (F.abs(F.col("mean") - F.col("b_mean")) > mean_shift_stds * F.coalesce("b_std", F.lit(0.0))).alias("bad")))
    return rows.select("part", "column", F.inline(checks)).where("bad").drop("bad")
