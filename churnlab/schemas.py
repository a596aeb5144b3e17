"""Explicit schemas: no per-run inference pass over the input."""

from pyspark.sql import types as T

TRAIN = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("is_churn", T.IntegerType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("payment_method_id", T.IntegerType()),
    T.StructField("payment_plan_days", T.IntegerType()),
    T.StructField("plan_list_price", T.LongType()),
    T.StructField("actual_amount_paid", T.LongType()),
    T.StructField("is_auto_renew", T.IntegerType()),
    T.StructField("transaction_date", T.IntegerType()),
    T.StructField("membership_expire_date", T.IntegerType()),
    T.StructField("is_cancel", T.IntegerType()),
])

MEMBERS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("city", T.IntegerType()),
    T.StructField("bd", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("registered_via", T.IntegerType()),
    T.StructField("registration_init_time", T.IntegerType()),
])

USER_LOGS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("date", T.IntegerType()),
    *[T.StructField(c, T.IntegerType()) for c in ("num_25", "num_50", "num_75", "num_985", "num_100", "num_unq")],
    T.StructField("total_secs", T.DoubleType()),
])

# Fixed values (must equal the reference's): feature column order every consumer of the
# modelling frame declares, and the column groups each step works on.
FEATURE_COLUMNS = [
    "msno", "is_churn", "regist_trans", "mst_frq_plan_days", "revenue", "regist_cancels", "bd", "tenure",
    "num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs",
    "city", "gender", "registered_via", "qtr_trans", "mst_frq_pay_met", "is_auto_renew",
]
LOG_COLUMNS = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs"]
IMPUTE_COLUMNS = LOG_COLUMNS + ["tenure"]
CATEGORICAL_COLUMNS = ["city", "gender", "registered_via", "qtr_trans", "mst_frq_pay_met", "is_auto_renew"]
RARE_COLUMNS = ["registered_via", "mst_frq_pay_met", "city"]
LOG1P_COLUMNS = ["regist_trans", "mst_frq_plan_days", "revenue", "regist_cancels"]

FEATURES = T.StructType(
    [T.StructField("msno", T.StringType()), T.StructField("is_churn", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURE_COLUMNS[2:6]]
    + [T.StructField("bd", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURE_COLUMNS[7:]]
)

PREDICTIONS = T.StructType([
    T.StructField("is_churn", T.IntegerType()),
    T.StructField("prediction", T.DoubleType()),
])

# Declared levels of the categorical columns after rare bucketing (one-hot output).
LEVELS = {
    "city": [*map(str, range(25)), "99", "other"],
    "gender": ["male", "female", "other"],
    "registered_via": ["3", "4", "5", "6", "7", "13", "other"],
    "qtr_trans": ["1", "2", "3", "4"],
    "mst_frq_pay_met": ["1", "2", "3", "4", "5", "other"],
    "is_auto_renew": ["0", "1"],
}
