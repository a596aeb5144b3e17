"""Registered queries for F1-F9 (feature assembly) and their oracles."""

from __future__ import annotations


from churnlab.operators import assemble, logs, members, transactions
from churnlab.plans import features
from churnlab.plans.oracle import parse_ymd, with_views
from churnlab.plans.registry import register
from churnlab.schemas import LOG_COLUMNS, LOG1P_COLUMNS
from churnlab.sources import adapters

_JOINED_DOUBLES = tuple(LOG_COLUMNS)


@register("txn_typed", with_views(f"""
SELECT *, {parse_ymd('transaction_date')} AS transaction_dt, {parse_ymd('membership_expire_date')} AS expire_dt,
       CAST(quarter({parse_ymd('transaction_date')}) AS INTEGER) AS quarter,
       CAST(quarter({parse_ymd('membership_expire_date')}) AS INTEGER) AS quarter_end
FROM transactions""", "transactions"))
def q_txn_typed(spark, sf_dir):
    return transactions.txn_typed(adapters.transactions(spark, sf_dir))


@register("txn_modes", with_views("""
SELECT msno, mst_frq_plan_days, mst_frq_pay_met, is_auto_renew, qtr_trans FROM txn_features""", "txn_features"))
def q_txn_modes(spark, sf_dir):
    return transactions.txn_modes(adapters.transactions(spark, sf_dir))


@register("txn_features", with_views("SELECT * FROM txn_features", "txn_features"))
def q_txn_features(spark, sf_dir):
    return transactions.txn_features(adapters.transactions(spark, sf_dir))


@register("churn_label", with_views("SELECT * FROM train", "train"))
def q_churn_label(spark, sf_dir):
    return adapters.train(spark, sf_dir)


@register("churn_label_expiry", with_views(f"""
SELECT msno, CAST(CASE WHEN nxt IS NOT NULL AND nxt <= expires + 30 THEN 0 ELSE 1 END AS INTEGER) AS is_churn
FROM (SELECT msno, coalesce(any_value(expires) FILTER (WHERE rn = 1), any_value(day) FILTER (WHERE rn = 1)) AS expires,
             any_value(nxt) AS nxt
      FROM (SELECT h.msno, day, expires, nxt, row_number() OVER (PARTITION BY h.msno ORDER BY day DESC, expires DESC NULLS LAST) AS rn
            FROM (SELECT msno, {parse_ymd('transaction_date')} AS day, {parse_ymd('membership_expire_date')} AS expires
                  FROM transactions) h
            LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS msno, min(CAST(o_orderdate AS DATE)) AS nxt FROM orders
                       WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' GROUP BY 1) n USING (msno)) r
      GROUP BY msno) t""", "transactions"))
def q_churn_label_expiry(spark, sf_dir):
    """The subscription rule: no new transaction within 30 days of the membership's expiry."""
    from churnlab.functions import yyyymmdd_to_date
    from churnlab.operators.labels import churn_label_by_expiry
    h = adapters.transaction_history(spark, sf_dir).withColumn("expires", yyyymmdd_to_date("membership_expire_date"))
    return churn_label_by_expiry(h, "msno", "activity_date", "expires", adapters.AS_OF, 30)


@register("members_filled", with_views("SELECT * FROM members_filled", "members_filled"))
def q_members_filled(spark, sf_dir):
    return members.members_filled(adapters.members(spark, sf_dir))


@register("log_means", with_views("SELECT * FROM log_means", "log_means"), round_cols=tuple(LOG_COLUMNS))
def q_log_means(spark, sf_dir):
    return logs.log_means(adapters.user_logs(spark, sf_dir))


@register("features_joined", with_views("SELECT * FROM features_joined", "features_joined"),
          round_cols=_JOINED_DOUBLES)
def q_features_joined(spark, sf_dir):
    return features.joined(spark, sf_dir)


@register("age_capped", with_views("SELECT msno, bd FROM aged", "aged"))
def q_age_capped(spark, sf_dir):
    return members.age_capped(features.joined(spark, sf_dir)).select("msno", "bd")


@register("tenure_years", with_views("SELECT msno, registration_init_time, tenure FROM aged", "aged"),
          round_cols=("tenure",))
def q_tenure_years(spark, sf_dir):
    return features.aged(spark, sf_dir).select("msno", "registration_init_time", "tenure")


@register("rare_categories", with_views(
    "SELECT feature, value, n, share FROM category_counts WHERE share < 0.005", "category_counts"),
    round_cols=("share",))
def q_rare_categories(spark, sf_dir):
    return assemble.rare_categories(features.aged(spark, sf_dir))


@register("rare_bucketed", with_views(
    "SELECT msno, registered_via, mst_frq_pay_met, city FROM features_clean", "features_clean"))
def q_rare_bucketed(spark, sf_dir):
    return assemble.rare_bucketed(features.aged(spark, sf_dir)).select(
        "msno", "registered_via", "mst_frq_pay_met", "city")


@register("log1p_features", with_views(
    f"SELECT msno, {', '.join(LOG1P_COLUMNS)} FROM features_clean", "features_clean"),
    round_cols=tuple(LOG1P_COLUMNS))
def q_log1p_features(spark, sf_dir):
    return assemble.log1p_features(features.joined(spark, sf_dir)).select("msno", *LOG1P_COLUMNS)


@register("features_clean", with_views("SELECT * FROM features_clean", "features_clean"),
          round_cols=_JOINED_DOUBLES + tuple(LOG1P_COLUMNS) + ("tenure",))
def q_features_clean(spark, sf_dir):
    return features.clean(spark, sf_dir)


@register("age_groups", with_views("""
SELECT msno, bd, CASE WHEN bd > 10 AND bd <= 18 THEN 'Teenagers' WHEN bd > 18 AND bd <= 35 THEN 'Young Adult'
                      WHEN bd > 35 AND bd <= 55 THEN 'Middle Age Adult' WHEN bd > 55 AND bd <= 99 THEN 'Elderly'
                 END AS age_group
FROM members""", "members"))
def q_age_groups(spark, sf_dir):
    return members.age_groups(adapters.members(spark, sf_dir).select("msno", "bd"))


@register("drop_incomplete", with_views("""
SELECT msno, is_churn, city, gender, registered_via, registration_init_time FROM features_joined
WHERE city IS NOT NULL AND gender IS NOT NULL AND registered_via IS NOT NULL AND registration_init_time IS NOT NULL""",
    "features_joined"))
def q_drop_incomplete(spark, sf_dir):
    cols = ["city", "gender", "registered_via", "registration_init_time"]
    return members.drop_incomplete(features.joined(spark, sf_dir), cols).select("msno", "is_churn", *cols)
