"""Registered queries for sources and sinks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.plans import features
from churnlab.plans.oracle import FEATURE_DOUBLES, view, with_views
from churnlab.plans.registry import register
from churnlab.schemas import FEATURES
from churnlab.sources import csv_io, feature_table
from churnlab.sources.tables import read_table

_FINAL_SCHEMA = T.StructType([T.StructField("split", T.StringType())] + FEATURES.fields)


@register("src_csv_roundtrip", with_views("SELECT * FROM final", "final"), round_cols=tuple(FEATURE_DOUBLES))
def q_src_csv_roundtrip(spark, sf_dir):
    path = csv_io.write_csv(features.final(spark, sf_dir), csv_io.export_dir(spark, "features_csv"), header=True)
    return csv_io.read_csv(spark, path, _FINAL_SCHEMA, header=True)


@register("src_headerless_csv", with_views("SELECT * FROM final", "final"), round_cols=tuple(FEATURE_DOUBLES))
def q_src_headerless_csv(spark, sf_dir):
    path = csv_io.write_csv(features.final(spark, sf_dir), csv_io.export_dir(spark, "features_nohdr"), header=False)
    return csv_io.read_csv(spark, path, _FINAL_SCHEMA, header=False)


# --------------------------------------------------------- feature table
HISTORY_COLS = ["actual_amount_paid", "payment_plan_days", "payment_method_id"]
ASOF = _dt.datetime(1998, 1, 1)


def history_records(spark, sf_dir):
    """Feature records derived from orders: one write per order; pending
    orders are deletion records for their customer at that time."""
    o = read_table(spark, sf_dir, "orders")
    bucket = F.col("o_orderkey") % 20
    return o.select(
        F.col("o_custkey").cast("string").alias("msno"),
        F.col("o_orderdate").alias("event_time"),
        F.col("o_orderkey").alias("write_seq"),
        F.round("o_totalprice").cast("bigint").alias("actual_amount_paid"),
        F.when(bucket < 15, 30).when(bucket < 19, 7).otherwise(90).cast("int").alias("payment_plan_days"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_method_id"),
        (F.col("o_orderstatus") == "P").alias("deleted"),
    )


view("history", [], """
SELECT CAST(o_custkey AS VARCHAR) AS msno, o_orderdate AS event_time, o_orderkey AS write_seq,
       CAST(round(o_totalprice) AS BIGINT) AS actual_amount_paid,
       CAST(CASE WHEN o_orderkey % 20 < 15 THEN 30 WHEN o_orderkey % 20 < 19 THEN 7 ELSE 90 END AS INTEGER)
         AS payment_plan_days,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_method_id,
       o_orderstatus = 'P' AS deleted
FROM orders""")

view("history_dedup", ["history"], """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY msno, event_time ORDER BY write_seq DESC) AS rn
                            FROM history) h WHERE rn = 1""")


def written_history(spark, sf_dir):
    """The history as a table on shared storage: two appends (records, then
    deletions), read back."""
    path = csv_io.export_dir(spark, "feature_history")
    recs = history_records(spark, sf_dir)
    feature_table.append_history(recs.where(~F.col("deleted")), path)
    feature_table.append_history(recs.where(F.col("deleted")), path)
    return feature_table.read_history(spark, path)


@register("feature_history_append", with_views(
    "SELECT msno, event_time, write_seq, actual_amount_paid, payment_plan_days, payment_method_id, deleted, "
    "CAST(date_trunc('month', event_time) AS DATE) AS event_month FROM history", "history"))
def q_feature_history_append(spark, sf_dir):
    return written_history(spark, sf_dir).select(
        "msno", "event_time", "write_seq", *HISTORY_COLS, "deleted", "event_month")


_DATASET = with_views(f"""
SELECT msno, event_time, {', '.join(HISTORY_COLS)} FROM history_dedup d
WHERE NOT deleted AND event_time > coalesce((SELECT max(event_time) FROM history_dedup x
                                             WHERE x.msno = d.msno AND x.deleted), TIMESTAMP '1900-01-01')""",
    "history_dedup")
_ASOF = with_views(f"""
SELECT msno, event_time, {', '.join(HISTORY_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY msno ORDER BY event_time DESC, write_seq DESC) AS rn
  FROM history WHERE event_time <= TIMESTAMP '{ASOF.isoformat(sep=' ')}') h
WHERE rn = 1 AND NOT deleted""", "history")


@register("feature_dataset", _DATASET)
def q_feature_dataset(spark, sf_dir):
    return feature_table.feature_dataset(written_history(spark, sf_dir), HISTORY_COLS)


@register("feature_dataset_asof", _ASOF)
def q_feature_dataset_asof(spark, sf_dir):
    return feature_table.feature_dataset_asof(written_history(spark, sf_dir), ASOF, HISTORY_COLS)


def bucketed_history(spark, sf_dir, buckets=8):
    """The history as a bucketed table: records, then deletions, in two appends."""
    path = csv_io.export_dir(spark, "feature_buckets")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    recs = history_records(spark, sf_dir)
    feature_table.append_bucketed(recs.where(~F.col("deleted")), table, path, buckets)
    feature_table.append_bucketed(recs.where(F.col("deleted")), table, path, buckets)
    return spark.table(table)


@register("feature_dataset_bucketed", _DATASET)
def q_feature_dataset_bucketed(spark, sf_dir):
    return feature_table.bucketed_dataset(bucketed_history(spark, sf_dir), HISTORY_COLS)


@register("feature_asof_bucketed", _ASOF)
def q_feature_asof_bucketed(spark, sf_dir):
    return feature_table.bucketed_dataset_asof(bucketed_history(spark, sf_dir), ASOF, HISTORY_COLS)


WRITTEN_AT = _dt.datetime(2024, 1, 31, 12, 30, 5)


@register("feature_ingest", with_views(f"""
SELECT msno, revenue, regist_trans, TIMESTAMP '{WRITTEN_AT.isoformat(sep=' ')}' AS event_time,
       '{WRITTEN_AT.isoformat()}.000Z' AS event_time_iso, false AS deleted, DATE '{WRITTEN_AT.date().replace(day=1)}' AS event_month
FROM txn_features""", "txn_features"))
def q_feature_ingest(spark, sf_dir):
    """Users' transaction features stamped with the time of their write, appended and read back."""
    from churnlab.operators.transactions import txn_features
    from churnlab.sources import adapters

    path = csv_io.export_dir(spark, "ingest")
    rows = txn_features(adapters.transactions(spark, sf_dir)).select("msno", "revenue", "regist_trans")
    feature_table.append_history(feature_table.stamped(rows, at=WRITTEN_AT), path)
    return feature_table.read_history(spark, path).select("msno", "revenue", "regist_trans", "event_time", "event_time_iso", "deleted", "event_month")
