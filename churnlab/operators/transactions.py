"""F2 transaction features: ONE aggregation per user.

The classic form is seven ``groupBy('msno')`` aggregates (four of them a Python
UDF over ``collect_list``) joined back together: seven scans and shuffles plus
a whole-group list in memory per user. Here the same columns come from one
``groupBy().agg()``: one scan, one exchange, partial aggregation map-side.
``mode(c, deterministic=True)`` is a JVM aggregate whose buffer holds one
counter per distinct value of the group, so a hot user costs a handful of
counters, not a list of all their rows. Ties go to the smallest value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions import yyyymmdd_to_date


def txn_typed(trans: DataFrame) -> DataFrame:
    """Parse the yyyyMMdd integer dates (malformed -> NULL) and add quarters."""
    start = yyyymmdd_to_date("transaction_date")
    end = yyyymmdd_to_date("membership_expire_date")
    return trans.withColumns({
        "transaction_dt": start,
        "expire_dt": end,
        "quarter": F.quarter(start),
        "quarter_end": F.quarter(end),
    })


def _mode(c) -> F.Column:
    return F.mode(c, deterministic=True)


def txn_modes(trans: DataFrame) -> DataFrame:
    quarter = F.quarter(yyyymmdd_to_date("transaction_date"))
    return trans.groupBy("msno").agg(
        _mode("payment_plan_days").alias("mst_frq_plan_days"),
        _mode("payment_method_id").alias("mst_frq_pay_met"),
        _mode("is_auto_renew").alias("is_auto_renew"),
        _mode(quarter).alias("qtr_trans"),
    )


def txn_features(trans: DataFrame) -> DataFrame:
    """regist_trans, mst_frq_pay_met, mst_frq_plan_days, revenue, is_auto_renew,
    regist_cancels, qtr_trans per user."""
    quarter = F.quarter(yyyymmdd_to_date("transaction_date"))
    return trans.groupBy("msno").agg(
        F.count("payment_method_id").alias("regist_trans"),
        _mode("payment_method_id").alias("mst_frq_pay_met"),
        _mode("payment_plan_days").alias("mst_frq_plan_days"),
        F.sum("actual_amount_paid").alias("revenue"),
        _mode("is_auto_renew").alias("is_auto_renew"),
        F.sum("is_cancel").alias("regist_cancels"),
        _mode(quarter).alias("qtr_trans"),
    )


def labelled_txn_features(history: DataFrame, date_col: str, as_of, horizon_days: int) -> DataFrame:
    """Churn label (F1) and transaction features (F2) from ONE aggregate over
    the full transaction history.

    Labelled users are exactly the users with a transaction before ``as_of``,
    so ``labels JOIN features`` is the same set of rows; computing both with
    conditional aggregates saves a second scan, a second shuffle and a join
    of the largest fact table. ``mode`` and ``count`` skip the NULLs that
    ``when(before, x)`` yields for later transactions.
    """
    d = F.col(date_col)
    cut = F.lit(as_of)
    before = d < cut

    def pre(c):
        return F.when(before, c if not isinstance(c, str) else F.col(c))

    quarter = F.quarter(yyyymmdd_to_date("transaction_date"))
    agg = history.groupBy("msno").agg(
        F.max(F.when(before, d)).alias("_last"),
        F.min(F.when(d >= cut, d)).alias("_next"),
        F.count(pre("payment_method_id")).alias("regist_trans"),
        _mode(pre("payment_method_id")).alias("mst_frq_pay_met"),
        _mode(pre("payment_plan_days")).alias("mst_frq_plan_days"),
        F.sum(pre("actual_amount_paid")).alias("revenue"),
        _mode(pre("is_auto_renew")).alias("is_auto_renew"),
        F.sum(pre("is_cancel")).alias("regist_cancels"),
        _mode(pre(quarter)).alias("qtr_trans"),
    )
    renewed = F.col("_next").isNotNull() & (F.col("_next") <= F.date_add("_last", horizon_days))
    return agg.where(F.col("_last").isNotNull()).select(
        "msno", F.when(renewed, 0).otherwise(1).cast("int").alias("is_churn"),
        "regist_trans", "mst_frq_pay_met", "mst_frq_plan_days", "revenue", "is_auto_renew", "regist_cancels",
        "qtr_trans")
