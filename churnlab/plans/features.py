"""Composite frames of the feature job, built from the adapter views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.operators import prep
from churnlab.operators.assemble import features_clean, rare_bucketed, unique_by
from churnlab.operators.logs import log_means
from churnlab.operators.members import age_capped, drop_incomplete, members_filled, tenure_years
from churnlab.operators.transactions import labelled_txn_features
from churnlab.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS, IMPUTE_COLUMNS, LOG_COLUMNS
from churnlab.session import cut_lineage
from churnlab.sources import adapters


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels + transaction features (one fused aggregate over the history)
    LEFT JOIN members LEFT JOIN log means."""
    labelled = labelled_txn_features(adapters.transaction_history(spark, sf_dir), "activity_date",
                                     adapters.AS_OF, adapters.HORIZON_DAYS)
    return (labelled.join(unique_by(members_filled(adapters.members(spark, sf_dir)), "msno"), on="msno", how="left")
                    .join(log_means(adapters.user_logs(spark, sf_dir)), on="msno", how="left"))


def aged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tenure_years(age_capped(joined(spark, sf_dir)), adapters.AS_OF)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_clean(joined(spark, sf_dir), adapters.AS_OF)


# ---------------------------------------------------------------- PySpark path

# Split weights/seeds and the column lists of each step.
SPLIT_WEIGHTS = (0.7, 0.2, 0.1)
SPLIT_NAMES = ("train", "test", "validation")
SPLIT_SEED = 200


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.split_assign(clean(spark, sf_dir), SPLIT_WEIGHTS, SPLIT_NAMES, SPLIT_SEED).drop(
        "registration_init_time")


def final_parts(spark: SparkSession, sf_dir: str) -> dict:
    """split -> mean-impute (fit on train) -> index (fit on train) ->
    oversample train. Returns the frames and the fitted models.

    The split frame feeds two fits, a class count and the output; it is a cheap
    projection of the checkpointed per-user frame, so the raw tables are read
    once.
    """
    s = split(spark, sf_dir)  # its per-user base is already checkpointed in ``clean``
    is_train = F.col("split") == "train"
    imputer = prep.fit_mean_imputer(s.where(is_train), IMPUTE_COLUMNS)
    imputed = prep.impute_mean(s, imputer, IMPUTE_COLUMNS)
    indexer = prep.fit_string_indexer(imputed.where(is_train), CATEGORICAL_COLUMNS)
    indexed = prep.string_index(imputed, indexer, CATEGORICAL_COLUMNS)
    train = indexed.where(is_train)
    over = prep.oversample(train)
    final = over.unionByName(indexed.where(~is_train))
    typed = final.select(
        "split", *[F.col(c).cast("double") if c not in ("msno", "is_churn", "bd") else F.col(c)
                   for c in FEATURE_COLUMNS])
    return {"split": s, "imputer": imputer, "imputed": imputed, "indexer": indexer,
            "indexed": indexed, "train": train, "oversampled": over, "final": typed}


def final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return final_parts(spark, sf_dir)["final"]


# ----------------------------------------------------------------- pandas path
# Fixed values (pandas path): 80/20 split seed, required member fields, outlier and scaling columns.
EDA_SEED = 123
EDA_REQUIRED = ["city", "gender", "registered_via", "registration_init_time"]
OUTLIER_COLUMNS = ["regist_trans", "regist_cancels", "total_secs", "tenure"]
SCALE_COLUMNS = ["regist_trans", "mst_frq_plan_days", "revenue", "regist_cancels", "bd", "tenure"]


def eda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows complete in member fields, age capped, tenure, rare buckets over
    the kept rows, 80/20 key-hash split (seed 123)."""
    df = drop_incomplete(joined(spark, sf_dir), EDA_REQUIRED)
    df = rare_bucketed(tenure_years(age_capped(df), adapters.AS_OF))
    return prep.split_assign(df, (0.8, 0.2), ("train", "test"), EDA_SEED)


def eda_imputed(spark: SparkSession, sf_dir: str) -> tuple:
    e = eda(spark, sf_dir)
    medians = prep.fit_median_imputer(e.where(F.col("split") == "train"), LOG_COLUMNS)
    return e, medians, prep.impute_with(e, medians)


def eda_tamed(spark: SparkSession, sf_dir: str) -> tuple:
    """Outliers replaced on the training rows only (test rows untouched)."""
    e, medians, imputed = eda_imputed(spark, sf_dir)
    is_train = F.col("split") == "train"
    stats = prep.fit_outlier_means(imputed.where(is_train), OUTLIER_COLUMNS)
    tamed = prep.outliers_to_mean(imputed.where(is_train), stats).unionByName(imputed.where(~is_train))
    return e, medians, imputed, stats, tamed


def eda_prepared(spark: SparkSession, sf_dir: str) -> dict:
    """pandas path: median impute -> outliers (train) -> standardise (fit on train)."""
    e, medians, imputed, out_stats, tamed = eda_tamed(spark, sf_dir)
    scale_stats = prep.fit_standardizer(tamed.where(F.col("split") == "train"), SCALE_COLUMNS)
    scaled = prep.standardize(tamed, scale_stats)
    return {"eda": e, "medians": medians, "imputed": imputed, "outlier_stats": out_stats,
            "tamed": tamed, "scale_stats": scale_stats, "scaled": scaled}
