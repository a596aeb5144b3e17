"""Registered queries: bias (Q6-Q13), data quality (Q1-Q5), descriptive
statistics (A6-A10, F20, O2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlab.operators import bias, drift, profile, quality, sketches
from churnlab.plans import features
from churnlab.plans.oracle import parse_ymd, view, with_views
from churnlab.plans.registry import register
from churnlab.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS
from churnlab.session import cut_lineage
from churnlab.sources import adapters
from churnlab.sources.csv_io import export_dir


# ----------------------------------------------------------------- bias
def bias_frame(spark, sf_dir):
    """Labels, facet, group and predictions per user; the predictions are a
    projection of the labelled frame (no second scan, no join)."""
    j = features.joined(spark, sf_dir).select("msno", "is_churn", "gender", "bd")
    return adapters.with_predictions(j).drop("score")


_BIAS_VIEW = """(SELECT j.msno, j.is_churn, j.gender, j.bd, p.prediction, coalesce(j.gender IN ('female'), false) AS d
 FROM features_joined j JOIN predictions p USING (msno))"""


def _kl(p, q):
    return f"(CASE WHEN ({p}) = 0 THEN 0.0 WHEN ({q}) = 0 THEN NULL ELSE ({p}) * ln(({p}) / ({q})) END)"


_PRE = f"""
SELECT n_a, n_d, (n_a - n_d) / nullif(n_a + n_d, 0) AS ci, qa - qd AS dpl,
       {_kl('(1 - qa)', '(1 - qd)')} + {_kl('qa', 'qd')} AS kl,
       ({_kl('(1 - qa)', '((1 - qa) + (1 - qd)) / 2')} + {_kl('qa', '(qa + qd) / 2')}
        + {_kl('(1 - qd)', '((1 - qa) + (1 - qd)) / 2')} + {_kl('qd', '(qa + qd) / 2')}) / 2 AS js,
       sqrt(((1 - qa) - (1 - qd)) * ((1 - qa) - (1 - qd)) + (qa - qd) * (qa - qd)) AS lp,
       (abs((1 - qa) - (1 - qd)) + abs(qa - qd)) / 2 AS tvd,
       greatest(abs((1 - qa) - (1 - qd)), abs(qa - qd)) AS ks
FROM (SELECT *, n_a1 / nullif(n_a, 0) AS qa, n_d1 / nullif(n_d, 0) AS qd
      FROM (SELECT *, n_a1 + n_a0 AS n_a, n_d1 + n_d0 AS n_d
            FROM (SELECT count(*) FILTER (WHERE NOT d AND is_churn = 1) AS n_a1,
                         count(*) FILTER (WHERE NOT d AND is_churn = 0) AS n_a0,
                         count(*) FILTER (WHERE d AND is_churn = 1) AS n_d1,
                         count(*) FILTER (WHERE d AND is_churn = 0) AS n_d0 FROM {_BIAS_VIEW} b) c) c2) c3"""

_PRE_COLS = ("ci", "dpl", "kl", "js", "lp", "tvd", "ks")


@register("bias_pretrain", with_views(_PRE, "features_joined", "predictions"), round_cols=_PRE_COLS)
def q_bias_pretrain(spark, sf_dir):
    return bias.pretraining_bias(bias_frame(spark, sf_dir), "is_churn", "gender", ["female"])


def _cdd_sql(label):
    return f"""
SELECT sum(n * (coalesce(nd0 / nullif(n0, 0), 0.0) - coalesce(nd1 / nullif(n1, 0), 0.0))) / CAST(sum(n) AS DOUBLE) AS cdd
FROM (SELECT bd, count(*) AS n, count(*) FILTER (WHERE {label} = 0) AS n0, count(*) FILTER (WHERE {label} = 1) AS n1,
             count(*) FILTER (WHERE d AND {label} = 0) AS nd0, count(*) FILTER (WHERE d AND {label} = 1) AS nd1
      FROM {_BIAS_VIEW} b GROUP BY bd) g"""


@register("bias_cddl", with_views(_cdd_sql("is_churn"), "features_joined", "predictions"), round_cols=("cdd",))
def q_bias_cddl(spark, sf_dir):
    return bias.conditional_demographic_disparity(bias_frame(spark, sf_dir), "is_churn", "gender", ["female"], "bd")


@register("bias_cddpl", with_views(_cdd_sql("prediction"), "features_joined", "predictions"), round_cols=("cdd",))
def q_bias_cddpl(spark, sf_dir):
    return bias.conditional_demographic_disparity(bias_frame(spark, sf_dir), "prediction", "gender", ["female"], "bd")


def _side(s, cond):
    return ", ".join(
        f"count(*) FILTER (WHERE {cond} AND is_churn = {y} AND prediction = {p}) AS {n}_{s}"
        for n, y, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0)))


def _r(a, b):
    return f"({a}) / nullif({b}, 0)"


_POST = f"""
SELECT {_r('tp_a + fp_a', 'n_a')} - {_r('tp_d + fp_d', 'n_d')} AS dppl,
       {_r('tp_d + fp_d', 'n_d')} / nullif({_r('tp_a + fp_a', 'n_a')}, 0) AS di,
       {_r('tp_a + fn_a', 'tp_a + fp_a')} - {_r('tp_d + fn_d', 'tp_d + fp_d')} AS dcacc,
       {_r('tn_d + fp_d', 'tn_d + fn_d')} - {_r('tn_a + fp_a', 'tn_a + fn_a')} AS dcr,
       {_r('tp_a', 'tp_a + fn_a')} - {_r('tp_d', 'tp_d + fn_d')} AS rd,
       {_r('tp_a', 'tp_a + fp_a')} - {_r('tp_d', 'tp_d + fp_d')} AS dar,
       {_r('tn_d', 'tn_d + fn_d')} - {_r('tn_a', 'tn_a + fn_a')} AS drr,
       {_r('tp_a + tn_a', 'n_a')} - {_r('tp_d + tn_d', 'n_d')} AS ad,
       {_r('fn_d', 'fp_d')} - {_r('fn_a', 'fp_a')} AS te,
       {_r('tn_a', 'tn_a + fp_a')} - {_r('tn_d', 'tn_d + fp_d')} AS sd
FROM (SELECT *, tp_a + fp_a + fn_a + tn_a AS n_a, tp_d + fp_d + fn_d + tn_d AS n_d
      FROM (SELECT {_side('a', 'NOT d')}, {_side('d', 'd')} FROM {_BIAS_VIEW} b) c) c2"""

_POST_COLS = ("dppl", "di", "dcacc", "dcr", "rd", "dar", "drr", "ad", "te", "sd")


@register("bias_posttrain", with_views(_POST, "features_joined", "predictions"), round_cols=_POST_COLS)
def q_bias_posttrain(spark, sf_dir):
    return bias.posttraining_bias(bias_frame(spark, sf_dir), "is_churn", "prediction", "gender", ["female"])


# Nearest rows over the standardised columns of the pandas path, in DuckDB by comparing all with all.
def _grid_sql(c):
    return f"coalesce(round((f.{c} - m.m_{c}) / CASE WHEN m.s_{c} = 0 THEN 1.0 ELSE m.s_{c} END * 1000), 0.0)::BIGINT AS {c}"


view("flip_points", ["aged", "predictions"], "SELECT f.msno, p.prediction, coalesce(f.gender IN ('female'), false) AS d, "
     + ", ".join(_grid_sql(c) for c in features.SCALE_COLUMNS) + " FROM aged f JOIN predictions p USING (msno), (SELECT "
     + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in features.SCALE_COLUMNS) + " FROM aged) m")
view("flip_pairs", ["flip_points"], "SELECT msno, prediction, near, near_pred, d2 FROM (SELECT x.msno, x.prediction, y.msno AS near, "
     "y.prediction AS near_pred, " + " + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in features.SCALE_COLUMNS)
     + " AS d2, row_number() OVER (PARTITION BY x.msno ORDER BY d2, y.msno) AS k FROM flip_points x, flip_points y "
     "WHERE x.d AND NOT y.d) z WHERE k = 1")


def flip_frame(spark, sf_dir):
    return cut_lineage(adapters.with_predictions(features.aged(spark, sf_dir)).drop("score"), "flip")


@register("bias_flip_pairs", with_views("SELECT * FROM flip_pairs", "flip_pairs"))
def q_bias_flip_pairs(spark, sf_dir):
    return bias.nearest_pairs(flip_frame(spark, sf_dir), features.SCALE_COLUMNS)


@register("bias_flip_nearest", with_views("""
SELECT n_d, n_up, n_down, (n_up - n_down) / nullif(n_d, 0) AS ft
FROM (SELECT count(*) AS n_d, count(*) FILTER (WHERE prediction = 0 AND near_pred = 1) AS n_up,
             count(*) FILTER (WHERE prediction = 1 AND near_pred = 0) AS n_down FROM flip_pairs) c""", "flip_pairs"), round_cols=("ft",))
def q_bias_flip_nearest(spark, sf_dir):
    return bias.flip_test_nearest(flip_frame(spark, sf_dir), features.SCALE_COLUMNS)


# -------------------------------------------------------------- quality
# The checked table is the split per-user frame before imputation and encoding;
# its training rows are the baseline, its validation rows the incoming data.
PROFILE_COLS = [c for c in FEATURE_COLUMNS if c != "msno"]
_TYPES = {c: "string" for c in ("city", "gender", "registered_via", "mst_frq_pay_met")} | {
    c: "int" for c in ("is_churn", "bd", "qtr_trans", "is_auto_renew")}


def _profile_sql(where, table="split"):
    parts = []
    for c in PROFILE_COLS:
        t = _TYPES.get(c, "double")
        x = f"CAST({c} AS DOUBLE)" if t != "string" else "CAST(NULL AS DOUBLE)"
        quartiles = ", ".join(f"quantile_cont({x}, {q}) AS p{round(100 * q)}" for q in (0.25, 0.5, 0.75))
        text = (f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)") if t in ("string", "int") else ("CAST(NULL AS VARCHAR)",) * 2
        total_text = f"CAST(sum({c}) AS VARCHAR)" if t == "int" else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{c}' AS feature, count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, avg({x}) AS mean, "
            f"sum({x}) AS total, stddev_samp({x}) AS std, min({x}) AS min, max({x}) AS max, "
            f"count(DISTINCT {c}) AS n_distinct, {'true' if t == 'int' else 'false'} AS integral, {quartiles}, "
            f"'{t}' AS type, {text[0]} AS min_text, {text[1]} AS max_text, "
            f"{total_text} AS total_text FROM {table} WHERE {where}")
    return " UNION ALL ".join(parts)


_STATS = ("mean", "total", "std", "min", "max", "p25", "p50", "p75")


def _rows(spark, sf_dir):
    """(training rows, validation rows), from one written table."""
    table = cut_lineage(features.split(spark, sf_dir), "checked")
    return tuple(table.where(F.col("split") == x).select(*PROFILE_COLS) for x in ("train", "validation"))


@register("profile_table", with_views(_profile_sql("split = 'train'"), "split"), round_cols=_STATS)
def q_profile_table(spark, sf_dir):
    prof = quality.profile_table(_rows(spark, sf_dir)[0], PROFILE_COLS, exact_distinct=True)
    return prof.withColumnRenamed("column", "feature")


view("domains", ["split"], " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM split WHERE split = 'train' AND {c} IS NOT NULL"
    for c in CATEGORICAL_COLUMNS))
view("profile_base", ["split"], _profile_sql("split = 'train'"))
view("profile_current", ["split"], _profile_sql("split = 'validation'"))

_CONSTRAINTS = """SELECT p.feature, p.type, coalesce((n - n_missing) / nullif(n, 0), 1.0) AS completeness,
       coalesce(min >= 0, true) AS non_negative, integral, d.domain_size
FROM profile_base p LEFT JOIN (SELECT feature, count(*) AS domain_size FROM domains GROUP BY feature) d ON d.feature = p.feature"""


@register("suggest_constraints", with_views(_CONSTRAINTS, "profile_base", "domains"), round_cols=("completeness",))
def q_suggest_constraints(spark, sf_dir):
    train = _rows(spark, sf_dir)[0]
    prof = quality.profile_table(train, PROFILE_COLS)
    domains = quality.category_domains(train, CATEGORICAL_COLUMNS)
    return quality.suggest_constraints(prof, domains).withColumnRenamed("column", "feature")


view("drift_join", ["profile_base", "profile_current"], """
SELECT b.feature, coalesce((b.n - b.n_missing) / nullif(b.n, 0), 1.0) AS completeness,
       coalesce(b.min >= 0, true) AS non_negative, b.mean AS b_mean, b.std AS b_std,
       c.mean AS c_mean, c.min AS c_min, coalesce((c.n - c.n_missing) / nullif(c.n, 0), 1.0) AS c_compl
FROM profile_base b JOIN profile_current c USING (feature)""")

_DRIFT = """
SELECT feature, 'completeness' AS "check", completeness AS baseline_value, c_compl AS observed_value
FROM drift_join WHERE c_compl < completeness
UNION ALL SELECT feature, 'non_negative', 0.0, c_min FROM drift_join WHERE non_negative AND c_min < 0
UNION ALL SELECT feature, 'mean_shift', b_mean, c_mean FROM drift_join WHERE abs(c_mean - b_mean) > 0.05 * b_std
UNION ALL SELECT feature, 'domain', CAST(NULL AS DOUBLE), CAST(count(*) AS DOUBLE) FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM split WHERE split = 'validation' AND {c} IS NOT NULL"
    for c in CATEGORICAL_COLUMNS) + """) v WHERE NOT EXISTS (SELECT 1 FROM domains d WHERE d.feature = v.feature AND d.value = v.value)
GROUP BY feature"""


@register("drift_violations", with_views(_DRIFT, "drift_join", "domains"),
          round_cols=("baseline_value", "observed_value"))
def q_drift_violations(spark, sf_dir):
    """Training baseline against the validation rows: the same columns, in the same form."""
    train, incoming = _rows(spark, sf_dir)
    base, cur = (quality.profile_table(x, PROFILE_COLS) for x in (train, incoming))
    domains = quality.category_domains(train, CATEGORICAL_COLUMNS)
    return (quality.drift_violations(base, cur, mean_shift_stds=0.05, domains=domains, current_rows=incoming,
                                     domain_cols=CATEGORICAL_COLUMNS)
            .withColumnRenamed("column", "feature"))


# ------------------------------------------------- distribution drift, merged sketches
DRIFT_NUMERIC = [c for c in PROFILE_COLS if c not in CATEGORICAL_COLUMNS and c != "is_churn"]


def _ks_sql(c):
    return f"""SELECT '{c}' AS feature, 'ks' AS "check", max(nb) AS n_baseline, max(nc) AS n_current, max(abs(cb / nb - cc / nc)) AS distance,
       sqrt(-ln(0.05 / 2) / 2) * sqrt((max(nb) + max(nc)) / (max(nb) * max(nc))) AS threshold
FROM (SELECT sum(b) OVER (ORDER BY v) AS cb, sum(c) OVER (ORDER BY v) AS cc, sum(b) OVER () AS nb, sum(c) OVER () AS nc
      FROM (SELECT CAST({c} AS DOUBLE) AS v, count(*) FILTER (WHERE split = 'train') AS b, count(*) FILTER (WHERE split = 'validation') AS c
            FROM split WHERE {c} IS NOT NULL AND split <> 'test' GROUP BY 1) g) w"""


def _tv_sql(c):
    return f"""SELECT '{c}' AS feature, 'tv' AS "check", max(nb) AS n_baseline, max(nc) AS n_current, sum(abs(b / nb - c / nc)) / 2 AS distance,
       sqrt((count(*) * ln(2) + ln(2 / 0.05)) / (2 * max(nb))) + sqrt((count(*) * ln(2) + ln(2 / 0.05)) / (2 * max(nc))) AS threshold
FROM (SELECT *, sum(b) OVER () AS nb, sum(c) OVER () AS nc
      FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) FILTER (WHERE split = 'train') AS b, count(*) FILTER (WHERE split = 'validation') AS c
            FROM split WHERE {c} IS NOT NULL AND split <> 'test' GROUP BY 1) g) w"""


@register("distribution_drift", with_views(
    "SELECT feature, \"check\", n_baseline::BIGINT AS n_baseline, n_current::BIGINT AS n_current, distance, threshold, distance > threshold AS drifted FROM ("
    + " UNION ALL ".join([_ks_sql(c) for c in DRIFT_NUMERIC] + [_tv_sql(c) for c in CATEGORICAL_COLUMNS]) + ") d WHERE n_baseline > 0 AND n_current > 0",
    "split"), round_cols=("distance", "threshold"))
def q_distribution_drift(spark, sf_dir):
    """Training rows against validation rows, every column."""
    train, incoming = _rows(spark, sf_dir)
    return drift.distribution_drift(train, incoming, DRIFT_NUMERIC, CATEGORICAL_COLUMNS).withColumnRenamed("column", "feature")


_LOG_COLS = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs"]


@register("profile_merged", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, CAST(sum({c}) AS DOUBLE) AS total, avg({c}) AS mean, "
    f"stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, true AS quartiles_ok, true AS distinct_ok FROM user_logs" for c in _LOG_COLS),
    "user_logs"), round_cols=("mean", "std"))
def q_profile_merged(spark, sf_dir):
    """The usage logs' profile merged from sketches that were stored month by month, the last
    month in a second run; the sketches' quartiles and distinct counts against the data."""
    logs = cut_lineage(adapters.user_logs(spark, sf_dir).withColumn("month", F.floor(F.col("date") / 100).cast("int")), "logs")
    path = export_dir(spark, "sketches")
    last = logs.agg(F.max("month")).first()[0]
    sketches.add_parts(logs.where(F.col("month") < F.lit(last)), path, "month", _LOG_COLS)
    sketches.add_parts(logs, path, "month", _LOG_COLS)
    prof = cut_lineage(sketches.merged_profile(sketches.stored_sketches(spark, path)), "merged")
    errors = sketches.rank_errors(logs, prof, _LOG_COLS)
    exact = logs.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in _LOG_COLS])))
    exact = exact.groupBy("column").agg(F.count_distinct("v").alias("d"))
    near = F.abs(F.col("n_distinct") - F.col("d")) <= F.greatest(F.lit(2.0), 0.08 * F.col("d"))  # five standard errors
    return (prof.join(errors, "column", "left").join(exact, "column")
            .select(F.col("column").alias("feature"), "n", "n_missing", "total", "mean", "std", "min", "max",
                    (F.coalesce("rank_error", F.lit(0.0)) <= 2 * sketches.RANK_ERROR).alias("quartiles_ok"), near.alias("distinct_ok")))


# ----------------------------------------------------------- descriptive
@register("dist_churn", with_views("""
SELECT is_churn, count(*) AS n, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM train) AS share
FROM train GROUP BY is_churn""", "train"), round_cols=("share",))
def q_dist_churn(spark, sf_dir):
    return profile.value_counts(adapters.train(spark, sf_dir), "is_churn")


def _dist_sql(expr, name):
    return with_views(f"""
SELECT {expr} AS {name}, count(*) AS n, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM transactions) AS share
FROM transactions GROUP BY 1""", "transactions")


@register("dist_plan_days", _dist_sql("payment_plan_days", "payment_plan_days"), round_cols=("share",))
def q_dist_plan_days(spark, sf_dir):
    return profile.value_counts(adapters.transactions(spark, sf_dir), "payment_plan_days")


@register("dist_pay_method", _dist_sql("payment_method_id", "payment_method_id"), round_cols=("share",))
def q_dist_pay_method(spark, sf_dir):
    return profile.value_counts(adapters.transactions(spark, sf_dir), "payment_method_id")


@register("dist_quarter", _dist_sql(f"CAST(quarter({parse_ymd('transaction_date')}) AS INTEGER)", "quarter"),
          round_cols=("share",))
def q_dist_quarter(spark, sf_dir):
    from churnlab.functions import yyyymmdd_to_date
    return profile.value_counts(adapters.transactions(spark, sf_dir),
                                F.quarter(yyyymmdd_to_date("transaction_date")), "quarter")


_AUDIT_COLS = [c for c in FEATURE_COLUMNS if c != "msno"]


@register("null_audit", with_views(" UNION ALL ".join(
    f"SELECT split, '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM split GROUP BY split"
    for c in _AUDIT_COLS), "split"))
def q_null_audit(spark, sf_dir):
    return profile.null_audit(features.split(spark, sf_dir), _AUDIT_COLS, by="split")


_JOINED_COLS = ["msno", "is_churn", "regist_trans", "mst_frq_pay_met", "mst_frq_plan_days", "revenue", "is_auto_renew",
                "regist_cancels", "qtr_trans", "city", "bd", "gender", "registered_via", "registration_init_time",
                "num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs"]


@register("missing_pct", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(count(*) FILTER (WHERE {c} IS NULL) / CAST(count(*) AS DOUBLE) * 100, 2) "
    f"AS pct_missing FROM features_joined" for c in _JOINED_COLS), "features_joined"))
def q_missing_pct(spark, sf_dir):
    return profile.missing_pct(features.joined(spark, sf_dir), _JOINED_COLS)


@register("plan_days_revenue", with_views("SELECT msno, mst_frq_plan_days, revenue FROM txn_features", "txn_features"))
def q_plan_days_revenue(spark, sf_dir):
    from churnlab.operators.transactions import txn_features
    return txn_features(adapters.transactions(spark, sf_dir)).select("msno", "mst_frq_plan_days", "revenue")


@register("tenure_revenue", with_views("SELECT msno, tenure, revenue FROM aged", "aged"), round_cols=("tenure",))
def q_tenure_revenue(spark, sf_dir):
    return features.aged(spark, sf_dir).select("msno", "tenure", "revenue")


@register("top_revenue", with_views("""
SELECT msno, revenue, regist_trans FROM txn_features ORDER BY revenue DESC NULLS LAST, msno ASC LIMIT 10""",
    "txn_features"))
def q_top_revenue(spark, sf_dir):
    from churnlab.operators.transactions import txn_features
    t = txn_features(adapters.transactions(spark, sf_dir)).select("msno", "revenue", "regist_trans")
    return profile.top_n(t, "revenue", 10, "msno")


# --------------------------------------------------------- baseline choice
_SPLIT_VERSION = {"train": 1, "test": 2, "validation": 3}


def baseline_registry(spark, sf_dir):
    """A stored table of versioned baselines: the profile of each split, one
    version per split (train v1, test v2 approved; validation v3 pending)."""
    table = cut_lineage(features.split(spark, sf_dir), "checked")
    path = export_dir(spark, "baselines")
    for split, version in _SPLIT_VERSION.items():
        prof = quality.profile_table(table.where(F.col("split") == split), PROFILE_COLS)
        quality.write_baseline(prof, path, version, approved=split != "validation")
    return quality.read_baselines(spark, path)


@register("baseline_used", with_views(f"""
SELECT f.skip_check, f.register_new, CASE WHEN f.register_new THEN 'new' ELSE 'existing' END AS baseline,
       CASE WHEN f.register_new THEN (SELECT coalesce(max(v), 0) + 1 FROM r)
            ELSE (SELECT max(v) FROM r WHERE approved) END AS version_used,
       NOT f.skip_check AS check_runs,
       CASE WHEN NOT f.register_new THEN CAST({len(PROFILE_COLS)} AS BIGINT) END AS n_columns,
       CASE WHEN NOT f.register_new THEN (SELECT n FROM r WHERE approved ORDER BY v DESC LIMIT 1) END AS n_rows
FROM (VALUES (true, true), (false, false), (false, true), (true, false)) f(skip_check, register_new)
""".replace("FROM r", "FROM (SELECT CASE split WHEN 'train' THEN 1 WHEN 'test' THEN 2 ELSE 3 END AS v, "
            "split <> 'validation' AS approved, count(*) AS n FROM split GROUP BY split) r"), "split"))
def q_baseline_used(spark, sf_dir):
    flags = spark.createDataFrame([(True, True), (False, False), (False, True), (True, False)],
                                  "skip_check boolean, register_new boolean")
    return quality.baseline_choices(baseline_registry(spark, sf_dir), flags)
