"""S10-S11 offline feature table: append-only history + dataset builders.

History rows carry a record key, an ``event_time``, a write sequence and a
``deleted`` flag, and are appended as Parquet partitioned by event month (so
time-bounded reads prune partitions). Before the write the rows are range-
partitioned on (month, key, row hash): each task writes a contiguous slice, so
a month produces a few files rather than one per task, a hot month is split
across tasks by key range, and a hot key within a month by the (deterministic)
row hash. Dataset rules:

* one row per (key, event_time): the latest write wins;
* a deletion at time t removes the key's records with event_time <= t;
  a key whose latest record is a deletion has no rows;
* ``as_of``: the latest surviving record per key with event_time <= as_of;
* a record without a ``deleted`` flag is not a deletion; one without a write
  sequence counts as written before all that have one.

The bucketed form (``append_bucketed``) stores the history as an external table
clustered by (key, slot of the event time) and partitioned by month. De-duplication and the
newest record of a slot then run inside the buckets, and no step moves the
history; what moves is one row per key (and slot, for the as-of dataset). A hot key lies in
up to ``SLOTS`` buckets, not in one.

All steps are aggregates (``max_by`` with partial aggregation) plus one join to
the written one-row-per-deleted-key table; no per-key window, so a hot key is
combined map-side or split at run time rather than sorted in a single task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.dates import iso_utc
from churnlab.session import cut_lineage


#: Slots that the records of a key are spread over in the bucketed form. Part of the stored format.
SLOTS = 32
_SLOT = "event_slot"


def stamped(df: DataFrame, event_time: str = "event_time", at: _dt.datetime | None = None) -> DataFrame:
    """Records of one write with their event time: ``at`` (now, in UTC, if not
    given) for all of them, beside its ISO text."""
    at = at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    out = df.withColumn(event_time, F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"))
    return out.withColumn(f"{event_time}_iso", iso_utc(F.col(event_time)))


def _stored(df: DataFrame, event_time: str) -> DataFrame:
    out = df.withColumn("event_month", F.trunc(F.to_date(event_time), "month"))
    return out if "deleted" in df.columns else out.withColumn("deleted", F.lit(False))


def append_history(df: DataFrame, path: str, event_time: str = "event_time", key: str = "msno",
                   num_partitions: int | None = None) -> None:
    out = _stored(df, event_time)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_hash = F.xxhash64(*[F.col(c) for c in out.columns])
    (out.repartitionByRange(n, "event_month", key, row_hash)
        .write.mode("append").partitionBy("event_month").parquet(path))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _flagged(history: DataFrame) -> DataFrame:
    return history.withColumn("deleted", F.coalesce("deleted", F.lit(False)))


def _order(*cols: str) -> F.Column:
    """Sort key for ``max_by`` under which a NULL is the smallest, and no row is left out."""
    return F.struct(*[x for c in cols for x in (F.col(c).isNotNull().alias(f"has_{c}"), F.col(c).alias(c))])


def _latest_per_event(history: DataFrame, key: str, event_time: str, seq: str, cols: list[str]) -> DataFrame:
    payload = F.struct(*[F.col(c) for c in cols], F.col("deleted"), F.col(seq))
    return (history.groupBy(key, event_time).agg(F.max_by(payload, _order(seq)).alias("r"))
                   .select(key, event_time, "r.*"))


def feature_dataset(history: DataFrame, cols: list[str], key: str = "msno", event_time: str = "event_time",
                    seq: str = "write_seq") -> DataFrame:
    """Records of each key newer than its last deletion.

    The deletion side reads key, time, sequence and flag only, and is written
    out (one row per deleted key). Both sides of the join then have a shuffle of
    their own, so Spark can split the partition of a key that holds much of the
    records, into as many parts as its measured size asks for."""
    history = _flagged(history)
    latest = history.groupBy(key, event_time).agg(F.max_by("deleted", _order(seq)).alias("deleted"))
    deletions = cut_lineage(latest.where("deleted").groupBy(key).agg(F.max(event_time).alias("_deleted_at")), "deletions")
    rec = _latest_per_event(history, key, event_time, seq, cols).where(~F.col("deleted"))
    kept = rec.join(deletions, key, "left").where(F.col("_deleted_at").isNull() | (F.col(event_time) > F.col("_deleted_at")))
    return kept.select(key, event_time, *cols)


def feature_dataset_asof(history: DataFrame, as_of: _dt.datetime, cols: list[str], key: str = "msno",
                         event_time: str = "event_time", seq: str = "write_seq") -> DataFrame:
    """The latest surviving record per key up to ``as_of``. On a written history
    the months after it are not read."""
    cut = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    h = _flagged(history).where(F.col(event_time) <= cut)
    if "event_month" in history.columns:
        h = h.where(F.col("event_month") <= F.lit(as_of.date().replace(day=1)))
    payload = F.struct(F.col(event_time), *[F.col(c) for c in cols], F.col("deleted"))
    latest = (h.groupBy(key).agg(F.max_by(payload, _order(event_time, seq)).alias("r"))
                .select(key, "r.*"))
    return latest.where(~F.col("deleted")).select(key, event_time, *cols)


def append_bucketed(df: DataFrame, table: str, path: str, buckets: int, event_time: str = "event_time", key: str = "msno") -> None:
    """Append records to the external table ``table`` at ``path``, made by the first append. A record is
    exchanged once, here; later appends must name the same number of buckets (Spark refuses
    another). A record without an event time is in slot 0."""
    slot = F.coalesce(F.pmod(F.xxhash64(event_time), F.lit(SLOTS)), F.lit(0)).cast("int")
    out = _stored(df, event_time).withColumn(_SLOT, slot)
    (out.repartition(buckets, key, _SLOT).write.mode("append").format("parquet").option("path", path)
        .partitionBy("event_month").bucketBy(buckets, key, _SLOT).sortBy(key, _SLOT).saveAsTable(table))


def bucketed_dataset(history: DataFrame, cols: list[str], key: str = "msno", event_time: str = "event_time",
                     seq: str = "write_seq") -> DataFrame:
    """``feature_dataset`` of a bucketed history. The deletion times (one row per deleted
    key) are repeated for each slot, so that they come to the records. They are as many as the
    deleted keys, and Spark's size estimate leaves the repeats out: a merge join, never a broadcast."""
    history = _flagged(history)
    flags = history.groupBy(key, _SLOT, event_time).agg(F.max_by("deleted", _order(seq)).alias("deleted"))
    deletions = cut_lineage(flags.where("deleted").groupBy(key).agg(F.max(event_time).alias("_deleted_at")), "deletions")
    ends = deletions.withColumn(_SLOT, F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    payload = F.struct(*cols, "deleted")
    rec = history.groupBy(key, _SLOT, event_time).agg(F.max_by(payload, _order(seq)).alias("r")).select(key, _SLOT, event_time, "r.*")
    kept = rec.where(~F.col("deleted")).join(ends.hint("merge"), [key, _SLOT], "left")
    kept = kept.where(F.col("_deleted_at").isNull() | (F.col(event_time) > F.col("_deleted_at")))
    return kept.select(key, event_time, *cols)


def bucketed_dataset_asof(history: DataFrame, as_of: _dt.datetime, cols: list[str], key: str = "msno",
                          event_time: str = "event_time", seq: str = "write_seq") -> DataFrame:
    """``feature_dataset_asof`` of a bucketed history: the newest record of every (key, slot)
    inside the buckets, then of the key over its slots."""
    h = (_flagged(history).where(F.col(event_time) <= F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"))
         .where(F.col("event_month") <= F.lit(as_of.date().replace(day=1))))
    payload, order = F.struct(event_time, *cols, "deleted"), _order(event_time, seq)
    slots = h.groupBy(key, _SLOT).agg(F.max_by(payload, order).alias("r"), F.max(order).alias("o"))
    latest = slots.groupBy(key).agg(F.max_by("r", "o").alias("r")).select(key, "r.*")
    return latest.where(~F.col("deleted")).select(key, event_time, *cols)
