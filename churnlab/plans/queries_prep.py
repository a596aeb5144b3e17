"""Registered queries for F10-F21 (split, impute, encode, rebalance, final frame)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlab.operators import prep
from churnlab.plans import features
from churnlab.plans.oracle import CATS, FEATURE_DOUBLES, IMPUTE, LOGS, OUTLIER, SCALE, with_views
from churnlab.plans.registry import register
from churnlab.schemas import LEVELS
from churnlab.sources import adapters


@register("split_assign", with_views("SELECT msno, split FROM split", "split"))
def q_split_assign(spark, sf_dir):
    return features.split(spark, sf_dir).select("msno", "split")


@register("impute_mean", with_views(f"SELECT msno, split, {', '.join(IMPUTE)} FROM imputed", "imputed"),
          round_cols=tuple(IMPUTE))
def q_impute_mean(spark, sf_dir):
    return features.final_parts(spark, sf_dir)["imputed"].select("msno", "split", *IMPUTE)


@register("impute_median", with_views(f"SELECT msno, split, {', '.join(LOGS)} FROM eda_imputed", "eda_imputed"),
          round_cols=tuple(LOGS))
def q_impute_median(spark, sf_dir):
    return features.eda_imputed(spark, sf_dir)[2].select("msno", "split", *LOGS)


@register("string_index", with_views(f"SELECT msno, split, {', '.join(CATS)} FROM indexed", "indexed"))
def q_string_index(spark, sf_dir):
    return features.final_parts(spark, sf_dir)["indexed"].select("msno", "split", *CATS)


@register("one_hot", with_views("SELECT msno, " + ", ".join(
    f"CASE WHEN CAST({c} AS VARCHAR) = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, lv in LEVELS.items() for v in lv)
    + " FROM eda", "eda"))
def q_one_hot(spark, sf_dir):
    """Columns of the declared levels, so the schema doesn't depend on the data."""
    return prep.one_hot(features.eda(spark, sf_dir).select("msno", *CATS), LEVELS)


@register("undummy", with_views(f"SELECT msno, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in CATS)} FROM eda",
                                "eda"))
def q_undummy(spark, sf_dir):
    e = features.eda(spark, sf_dir).select("msno", *CATS)
    return prep.undummy(prep.one_hot(e, LEVELS), CATS, LEVELS).select("msno", *CATS)


@register("outliers_to_mean", with_views(
    f"SELECT msno, {', '.join(OUTLIER)} FROM eda_tamed WHERE split = 'train'", "eda_tamed"),
    round_cols=tuple(OUTLIER))
def q_outliers_to_mean(spark, sf_dir):
    tamed = features.eda_tamed(spark, sf_dir)[-1]
    return tamed.where(F.col("split") == "train").select("msno", *OUTLIER)


@register("standardize", with_views(f"SELECT msno, split, {', '.join(SCALE)} FROM eda_scaled", "eda_scaled"),
          round_cols=tuple(SCALE))
def q_standardize(spark, sf_dir):
    return features.eda_prepared(spark, sf_dir)["scaled"].select("msno", "split", *SCALE)


@register("class_balance", with_views("SELECT * FROM class_balance", "class_balance"))
def q_class_balance(spark, sf_dir):
    return prep.class_balance(features.final_parts(spark, sf_dir)["train"])


@register("oversampled", with_views("SELECT msno, is_churn FROM final WHERE split = 'train'", "final"))
def q_oversampled(spark, sf_dir):
    return features.final_parts(spark, sf_dir)["oversampled"].select("msno", "is_churn")


@register("features_final", with_views("SELECT * FROM final", "final"), round_cols=tuple(FEATURE_DOUBLES))
def q_features_final(spark, sf_dir):
    return features.final(spark, sf_dir)


# ------------------------------------------------- exact splits, dictionaries
EXACT_STAGES = [(0.33, "test", 42), (0.125, "validation", 43)]  # fixed values: 67/33, then 87.5/12.5 of the rest


def _hash_sql(seed):
    return f"CAST(('0x' || substr(md5(msno || '|{seed}'), 1, 15)) AS BIGINT)"


@register("split_exact", with_views(f"""
SELECT msno, CASE WHEN k1 <= ceil(0.33 * n1) THEN 'test' WHEN k2 <= ceil(0.125 * n2) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY k1 <= ceil(0.33 * n1) ORDER BY {_hash_sql(43)}) AS k2,
             count(*) OVER (PARTITION BY k1 <= ceil(0.33 * n1)) AS n2
      FROM (SELECT msno, row_number() OVER (ORDER BY {_hash_sql(42)}) AS k1, count(*) OVER () AS n1 FROM features_clean) a) b""",
    "features_clean"))
def q_split_exact(spark, sf_dir):
    return prep.split_exact(features.clean(spark, sf_dir).select("msno"), EXACT_STAGES, "train")


_LEVELS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), 'other') AS level, count(*) AS n FROM {t} GROUP BY 2"
    for c, t in (("msno", "transactions"), ("transaction_date", "transactions")))


@register("dictionary_levels", with_views(f"""
SELECT "column", level, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) - 1 AS index
FROM ({_LEVELS_SQL}) v""", "transactions"))
def q_dictionary_levels(spark, sf_dir):
    """The vocabularies of columns with many levels: users and dates of the transactions."""
    return prep.fit_dictionary(adapters.transactions(spark, sf_dir), ["msno", "transaction_date"])


@register("dictionary_index", with_views(f"""
SELECT t.transaction_date AS raw_date, t.plan_list_price, CAST(u.index AS DOUBLE) AS msno, CAST(d.index AS DOUBLE) AS transaction_date
FROM transactions t
JOIN (SELECT level, row_number() OVER (ORDER BY n DESC, level) - 1 AS index FROM ({_LEVELS_SQL}) v WHERE "column" = 'msno') u ON u.level = t.msno
JOIN (SELECT level, row_number() OVER (ORDER BY n DESC, level) - 1 AS index FROM ({_LEVELS_SQL}) v WHERE "column" = 'transaction_date') d
  ON d.level = CAST(t.transaction_date AS VARCHAR)""", "transactions"))
def q_dictionary_index(spark, sf_dir):
    """Transactions with user and date as indices of their own vocabularies; users by the join that any vocabulary takes."""
    t = adapters.transactions(spark, sf_dir).select("msno", "transaction_date", "plan_list_price", F.col("transaction_date").alias("raw_date"))
    dictionary = prep.fit_dictionary(t, ["msno", "transaction_date"])
    return prep.dictionary_index(t, dictionary, ["msno", "transaction_date"], small=1000)
