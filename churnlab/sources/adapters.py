"""Adapter views: the subscription tables derived from the supplied star schema.

The same expressions are written in DuckDB SQL in ``churnlab.plans.oracle``;
the two must stay in step. Every view is a plain projection/aggregation over
the base tables, so its cost grows with them and Catalyst prunes columns and
pushes the date filter into the parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions import date_to_yyyymmdd, hash_unit
from churnlab.operators.labels import churn_label
from churnlab.sources.tables import read_table

# Fixed adapter parameters (FIXTURES.md §2).
AS_OF = _dt.date(1999, 1, 1)
HORIZON_DAYS = 730
REGISTRATION_EPOCH = _dt.date(1995, 1, 1)


def _ntz(d: _dt.date):
    return F.lit(d.isoformat() + " 00:00:00").cast("timestamp_ntz")


def transactions(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderdate") < _ntz(as_of))
    return _transaction_columns(o)


def transaction_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions (before and after the cut-off) with their activity date."""
    o = read_table(spark, sf_dir, "orders")
    return _transaction_columns(o, with_activity_date=True)


def _transaction_columns(o: DataFrame, with_activity_date: bool = False) -> DataFrame:
    method = F.substring("o_orderpriority", 1, 1).cast("int")
    bucket = F.col("o_orderkey") % 20
    plan_days = F.when(bucket < 15, 30).when(bucket < 19, 7).otherwise(90).cast("int")
    day = F.to_date("o_orderdate")
    amount = F.round("o_totalprice").cast("bigint")
    return o.select(
        F.col("o_custkey").cast("string").alias("msno"),
        method.alias("payment_method_id"),
        plan_days.alias("payment_plan_days"),
        amount.alias("plan_list_price"),
        amount.alias("actual_amount_paid"),
        F.when(method <= 3, 1).otherwise(0).cast("int").alias("is_auto_renew"),
        date_to_yyyymmdd(day).alias("transaction_date"),
        date_to_yyyymmdd(F.date_add(day, plan_days)).alias("membership_expire_date"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("int").alias("is_cancel"),
        *([day.alias("activity_date")] if with_activity_date else []),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    g = k % 3
    return c.select(
        k.cast("string").alias("msno"),
        F.when(k % 400 == 1, F.lit(99)).otherwise(F.col("c_nationkey")).cast("int").alias("city"),
        ((k * 7) % 101).cast("int").alias("bd"),
        F.when(g == 1, F.lit("male")).when(g == 2, F.lit("female")).alias("gender"),
        F.when(k % 300 == 0, F.lit(13)).otherwise(3 + k % 5).cast("int").alias("registered_via"),
        date_to_yyyymmdd(F.date_add(F.lit(REGISTRATION_EPOCH), (k % 1000).cast("int"))).alias("registration_init_time"),
    )


def user_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, day): counts by event type, distinct props, total value."""
    e = read_table(spark, sf_dir, "events")
    t = F.col("event_type")
    return (
        e.groupBy(F.col("user_id").cast("string").alias("msno"), date_to_yyyymmdd(F.to_date("ts")).alias("date"))
        .agg(
            F.count_if(t == "view").cast("int").alias("num_25"),
            F.count_if(t == "click").cast("int").alias("num_50"),
            F.count_if(t == "signup").cast("int").alias("num_75"),
            F.count_if(t == "error").cast("int").alias("num_985"),
            F.count_if(t == "purchase").cast("int").alias("num_100"),
            # 16 bytes a value in the shuffle, however long the text
            F.count_distinct(F.unhex(F.md5(F.col("props").cast("binary")))).cast("int").alias("num_unq"),
            F.sum("value").alias("total_secs"),
        )
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as (msno, activity_date), before and after the cut-off."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").cast("string").alias("msno"), F.to_date("o_orderdate").alias("activity_date"))


def train(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    return churn_label(order_history(spark, sf_dir), "msno", "activity_date", as_of, horizon_days)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic synthetic scores for the evaluation family (see ``with_predictions``)."""
    return with_predictions(train(spark, sf_dir)).select("msno", "is_churn", "score", "prediction")


def with_predictions(labelled: DataFrame) -> DataFrame:
    """Add the synthetic score (hash score, raised by 0.2 for churners, capped
    at 1) and the hard label at 0.5 to any frame of (msno, is_churn): a pure
    projection, so frames that already carry the labels need no join."""
    score = F.least(F.lit(1.0), hash_unit("msno", "score") + F.lit(0.2) * F.col("is_churn"))
    return labelled.withColumns({
        "score": score, "prediction": F.when(score >= 0.5, 1.0).otherwise(0.0)})
