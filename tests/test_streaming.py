"""Drift monitor over a file stream (availableNow trigger)."""

import os
import tempfile

from pyspark.sql import functions as F

from churnlab.operators.quality import profile_table
from churnlab.streaming.monitor import drift_monitor


def test_drift_monitor_flags_injected_drift(spark):
    root = tempfile.mkdtemp(prefix="churnlab-stream-", dir="/tmp")
    src, sink = os.path.join(root, "in"), os.path.join(root, "out")
    base = spark.range(200).select(F.col("id").cast("double").alias("x"))
    clean = base
    drifted = base.select((F.col("x") + 1000).alias("x"))
    clean.write.parquet(os.path.join(src, "b0"))
    drifted.write.mode("append").parquet(os.path.join(src, "b0"))
    stream = spark.readStream.schema("x double").parquet(os.path.join(src, "b0"))
    q = drift_monitor(stream, profile_table(base, ["x"]), ["x"], sink,
                      checkpoint_location=os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    assert got.where("check = 'mean_shift'").count() >= 1


# ------------------------------------------------------------ event-time windows
import datetime as dt  # noqa: E402

import numpy as np  # noqa: E402

from churnlab.operators.quality import profile_table as batch_profile  # noqa: E402
from churnlab.streaming.monitor import sketch_monitor, window_profiles, window_violations  # noqa: E402

EVENT = "t timestamp, x double, s string"


def feed(spark, folder, name, rows):
    days = [(dt.datetime(2024, 1, d, 12), x, s) for d, x, s in rows]
    spark.createDataFrame(days, EVENT).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, sink, state, **options):
    stream = spark.readStream.schema(EVENT).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    query = sketch_monitor(stream, "t", ["x", "s"], f"{folder}/{sink}", f"{folder}/{state}", **options)
    query.awaitTermination()
    return query


def profiles(spark, folder, sink):
    return {(r.part[:10], r.column): r for r in window_profiles(spark, f"{folder}/{sink}").collect()}


def test_windows_over_two_triggers(spark, tmp_path):
    """State merges what two triggers bring to a window; a row behind the watermark is left out."""
    folder, rnd = str(tmp_path), np.random.default_rng(0)
    first = [(1 + i % 3, float(rnd.normal(5, 1)), "ab"[i % 2]) for i in range(300)]
    feed(spark, f"{folder}/in", "one", first)
    run(spark, folder, "out", "state", delay="5 days")
    second = [(3, float(rnd.normal(5, 1)), "c") for _ in range(50)] + [(20, -3.0, None), (20, None, "z")]
    feed(spark, f"{folder}/in", "two", second)
    run(spark, folder, "out", "state", delay="5 days")
    feed(spark, f"{folder}/in", "three", [(2, 1000.0, "late"), (19, 7.0, "y")])
    run(spark, folder, "out", "state", delay="5 days")
    got = profiles(spark, folder, "out")
    for day in (1, 2, 3):
        x = np.array([v for d, v, _ in first + second if d == day])
        r = got[f"2024-01-{day:02d}", "x"]
        assert r.n == len(x) and (r.min, r.max) == (x.min(), x.max()) and abs(r.mean - x.mean()) < 1e-9 and abs(r.std - x.std(ddof=1)) < 1e-9
        assert got[f"2024-01-{day:02d}", "s"].n_distinct == (3 if day == 3 else 2)
    assert got["2024-01-19", "x"].n == 1 and (got["2024-01-20", "x"].n, got["2024-01-20", "x"].n_missing) == (2, 1)
    baseline = batch_profile(spark.createDataFrame([(v, s) for _, v, s in first], "x double, s string"))
    bad = {(r.part[:10], r.column, r.check) for r in window_violations(window_profiles(spark, f"{folder}/out"), baseline, 1.0).collect()}
    assert {("2024-01-20", "x", "non_negative"), ("2024-01-20", "x", "completeness"), ("2024-01-20", "x", "mean_shift"),
            ("2024-01-20", "s", "completeness"), ("2024-01-19", "x", "mean_shift")} == bad


def test_a_replayed_epoch_replaces_itself(spark, tmp_path):
    """The same input under a new state writes the same epoch again: nothing counts twice."""
    folder = str(tmp_path)
    feed(spark, f"{folder}/in", "one", [(1, 1.0, "a"), (1, 2.0, "b")])
    for state in ("first", "second"):
        run(spark, folder, "out", state)
    r = profiles(spark, folder, "out")["2024-01-01", "x"]
    assert (r.n, r.total, r.mean) == (2, 3.0, 1.5)
