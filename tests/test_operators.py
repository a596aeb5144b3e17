"""Edge cases per operator (FIXTURES.md section 3) on tiny in-memory frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from churnlab.functions import yyyymmdd_to_date
from churnlab.operators import assemble, bias, evaluation as ev, members, prep, quality, transactions
from churnlab.operators.labels import churn_label


def test_mode_smallest_on_tie_null_and_single(spark):
    df = spark.createDataFrame(
        [("a", 4), ("a", 8), ("a", 8), ("a", 4), ("b", None), ("c", 7)], "msno string, payment_plan_days int")
    df = df.withColumns({"payment_method_id": F.col("payment_plan_days"), "is_auto_renew": F.lit(1),
                         "transaction_date": F.lit(20170331)})
    got = {r.msno: r.mst_frq_plan_days for r in transactions.txn_modes(df).collect()}
    assert got == {"a": 4, "b": None, "c": 7}


def test_log_mean_ignores_zero(spark):
    from churnlab.operators.logs import log_means
    rows = [("u", 1, 1, 1, 1, 1, 1, s) for s in (0.0, 1.0, math.e)]
    df = spark.createDataFrame(rows, "msno string, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, "
                                     "num_unq int, total_secs double")
    assert log_means(df).first().total_secs == pytest.approx(0.5)


def test_dates_parse_or_null(spark):
    df = spark.createDataFrame([(20170331,), (20169931,), (None,)], "d int")
    got = [r.x for r in df.select(yyyymmdd_to_date("d").alias("x")).collect()]
    assert got == [dt.date(2017, 3, 31), None, None]


def test_age_cap(spark):
    df = spark.createDataFrame([(80,), (81,), (None,), (-5,)], "bd int")
    assert [r.bd for r in members.age_capped(df).collect()] == [80, 0, 0, -5]


def test_age_groups(spark):
    df = spark.createDataFrame([(v,) for v in (10, 11, 18, 19, 99, 100)], "bd int")
    got = [r.age_group for r in members.age_groups(df).collect()]
    assert got == [None, "Teenagers", "Teenagers", "Young Adult", "Elderly", None]


def test_rare_bucket_boundary(spark):
    # 200 rows: value 'x' once (share exactly 0.005 -> kept), NULL once -> other
    rows = [(1,)] + [(None,)] + [(2,)] * 198
    df = spark.createDataFrame(rows, "city int").withColumns(
        {"registered_via": F.lit(3), "mst_frq_pay_met": F.lit(1)})
    out = assemble.rare_bucketed(df).groupBy("city").count().collect()
    assert {r.city: r["count"] for r in out} == {"1": 1, "other": 1, "2": 198}
    rows2 = [(1,)] + [(2,)] * 200  # 1/201 < 0.005 -> other
    df2 = spark.createDataFrame(rows2, "city int").withColumns(
        {"registered_via": F.lit(3), "mst_frq_pay_met": F.lit(1)})
    assert {r.city for r in assemble.rare_bucketed(df2).collect()} == {"other", "2"}


def test_indexer_ties_alphabetical_unseen_last(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "g string")
    model = prep.fit_string_indexer(train, ["g"])
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "g string")
    got = [r.g for r in prep.string_index(test, model, ["g"]).collect()]
    # c (2) first, then a, b tie alphabetically; unseen 'z' and 'other' -> extra index 3
    assert got == [1.0, 2.0, 0.0, 3.0, 3.0]


def test_imputer_all_null_in_test_uses_train_mean(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    test = spark.createDataFrame([(None,), (None,)], "x double")
    m = prep.fit_mean_imputer(train, ["x"])
    assert [r.x for r in prep.impute_mean(test, m, ["x"]).collect()] == [2.0, 2.0]


def test_exact_median_even_odd(spark):
    df = spark.createDataFrame([(float(v), float(v)) for v in (5, 1, 3, 2)] + [(None, 9.0)], "a double, b double")
    med = prep.exact_medians(df, ["a", "b"])
    assert med == {"a": 2.5, "b": 3.0}


def test_oversample_edge_cases(spark):
    # majority smaller than minority: ratio 0 -> minority kept once
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1)], "msno string, is_churn int")
    assert prep.oversample(df).count() == 3
    # no minority: no failure, nothing duplicated
    df2 = spark.createDataFrame([("a", 0), ("b", 0)], "msno string, is_churn int")
    assert prep.oversample(df2).count() == 2
    df3 = spark.createDataFrame([("a", 0)] * 7 + [("b", 1)] * 2, "msno string, is_churn int")
    out = prep.oversample(df3)
    assert out.where("is_churn = 1").count() == 6 and out.where("is_churn = 0").count() == 7


def test_split_stable_under_repartition(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("msno"))
    a = {r.msno: r.split for r in prep.split_assign(df).collect()}
    b = {r.msno: r.split for r in prep.split_assign(df.repartition(13)).collect()}
    assert a == b
    shares = {s: list(a.values()).count(s) / len(a) for s in set(a.values())}
    assert abs(shares["train"] - 0.7) < 0.05


def test_metrics_no_predicted_positive(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "is_churn int, prediction double")
    r = ev.eval_report(df).first()
    assert r.precision == 0 and r.f1 == 0 and r.auc_score == 0.5


def test_auc_hard_vs_prob(spark):
    df = spark.createDataFrame([(1, 0.9, 1.0), (0, 0.8, 1.0), (1, 0.7, 1.0), (0, 0.1, 0.0)],
                               "is_churn int, score double, prediction double")
    hard = ev.eval_report(df).first().auc_score
    assert hard == pytest.approx((1.0 + 0.5) / 2)
    assert ev.auc_prob(df).first().auc == pytest.approx(0.75)


def test_gate_is_strict(spark):
    doc = spark.createDataFrame([('{"classification_metrics": {"auc_score": {"value": 0.75}}}',)], "report string")
    assert ev.auc_gate(doc).first().passed is False


def test_bias_identical_and_empty_facets(spark):
    rows = [("female", 1, 1.0), ("female", 0, 0.0), ("male", 1, 1.0), ("male", 0, 0.0)]
    df = spark.createDataFrame(rows, "gender string, is_churn int, prediction double")
    pre = bias.pretraining_bias(df).first()
    assert pre.dpl == 0 and pre.kl == 0 and pre.ci == 0
    post = bias.posttraining_bias(df).first()
    assert post.di == 1 and post.dppl == 0
    empty = bias.pretraining_bias(df, facet_values=["none"]).first()
    assert empty.dpl is None and empty.kl is None


def test_baseline_truth_table(spark, tmp_path):
    """The choice follows the stored versions, and changes when they do."""
    path = str(tmp_path / "baselines")
    flags = spark.createDataFrame([(True, True), (False, False)], "skip_check boolean, register_new boolean")

    def choices():
        got = quality.baseline_choices(quality.read_baselines(spark, path), flags).collect()
        return {r.baseline: (r.version_used, r.check_runs, r.n_rows) for r in got}
    quality.write_baseline(quality.profile_table(spark.range(5)), path, 1, True)
    assert choices() == {"new": (2, False, None), "existing": (1, True, 5)}
    quality.write_baseline(quality.profile_table(spark.range(9)), path, 2, False)
    assert choices() == {"new": (3, False, None), "existing": (1, True, 5)}
    quality.write_baseline(quality.profile_table(spark.range(7)), path, 3, True)
    assert choices() == {"new": (4, False, None), "existing": (3, True, 7)}


def test_drift_found_and_clean_silent(spark):
    base = spark.createDataFrame([(float(i), i) for i in range(100)], "x double, y int")
    prof = quality.profile_table(base)
    assert quality.drift_violations(prof, prof).count() == 0
    bad = spark.createDataFrame([(None, -5)] * 10 + [(500.0, 1)] * 10, "x double, y int")
    checks = {(r.column, r.check) for r in quality.drift_violations(prof, quality.profile_table(bad)).collect()}
    assert ("x", "completeness") in checks and ("y", "non_negative") in checks and ("x", "mean_shift") in checks


def test_churn_label(spark):
    d = dt.date
    rows = [("a", d(1998, 1, 1)), ("a", d(1999, 6, 1)),   # renewed within horizon -> 0
            ("b", d(1998, 1, 1)), ("b", d(2001, 1, 1)),   # renewed too late -> 1
            ("c", d(1998, 5, 5)),                          # never renewed -> 1
            ("e", d(1999, 2, 2))]                          # no activity before cut-off -> unlabelled
    df = spark.createDataFrame(rows, "msno string, d date")
    got = {r.msno: r.is_churn for r in churn_label(df, "msno", "d", d(1999, 1, 1), 730).collect()}
    assert got == {"a": 0, "b": 1, "c": 1}


def test_feature_dataset_rules(spark):
    from churnlab.sources import feature_table as ft
    ts = lambda s: dt.datetime.fromisoformat(s)
    rows = [("k1", ts("2020-01-01 00:00:00"), 1, 10, False), ("k1", ts("2020-01-01 00:00:00"), 2, 11, False),
            ("k2", ts("2020-01-01 00:00:00"), 3, 5, False), ("k2", ts("2020-02-01 00:00:00"), 4, 0, True)]
    h = spark.createDataFrame(rows, "msno string, event_time timestamp_ntz, write_seq int, v int, deleted boolean")
    got = [(r.msno, r.v) for r in ft.feature_dataset(h, ["v"]).collect()]
    assert got == [("k1", 11)]


def test_shap_linear_model_exact(spark):
    """KernelSHAP on a linear model returns coefficient x (x - baseline)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from churnlab.operators import explain
    import numpy as np

    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 3))
    y = (X @ np.array([1.0, -2.0, 0.5]) + rng.normal(scale=0.5, size=200) > 0).astype(int)
    df = spark.createDataFrame([(str(i), float(a), float(b), float(c), int(t)) for i, (a, b, c), t
                                in zip(range(200), X, y)], "msno string, a double, b double, c double, label int")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"),
                             LogisticRegression(labelCol="label")]).fit(df)
    base = {"a": 0.0, "b": 0.0, "c": 0.0}
    local = explain.shap_local(model, df.limit(5), base, ["a", "b", "c"], n_samples=200, seed=1)
    # efficiency: values sum to f(x) - f(baseline)
    for r in local.groupBy("msno").agg(F.sum("shap_value").alias("s"), F.first("f_x").alias("fx"),
                                       F.first("f_baseline").alias("fb")).collect():
        assert r.s == pytest.approx(r.fx - r.fb, abs=1e-9)


def test_running_totals_match_global_cumsum(spark):
    from churnlab.functions.running import running_totals
    import random
    rnd = random.Random(3)
    rows = [(g, float(v), rnd.randint(1, 5)) for g in ("x", "y") for v in rnd.sample(range(10000), 300)]
    df = spark.createDataFrame(rows, "g string, v double, k int")
    got = {(r.g, r.v): r.cum_k for r in running_totals(df, "v", ["k"], group="g", slices=7).collect()}
    for g in ("x", "y"):
        acc = 0
        for _, v, k in sorted(r for r in rows if r[0] == g):
            acc += k
            assert got[(g, v)] == acc


def test_members_key_unique(spark):
    from churnlab.sources import adapters
    from conftest import SF_SMALL
    assemble.assert_unique_key(adapters.members(spark, SF_SMALL), "msno")
    with pytest.raises(ValueError):
        assemble.assert_unique_key(spark.createDataFrame([("a",), ("a",)], "msno string"), "msno")


def test_iso_utc_text(spark):
    from churnlab.functions import iso_utc
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2, 3, 4, 5, 678000),)], "t timestamp_ntz")
    assert df.select(iso_utc("t").alias("s")).first().s == "2020-01-02T03:04:05.678Z"


def test_shap_background_set_efficiency(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from churnlab.operators import explain

    df = spark.range(60).select(F.col("id").cast("string").alias("msno"), (F.col("id") % 7).cast("double").alias("a"),
                                (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 2).cast("int").alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                             LogisticRegression(labelCol="label")]).fit(df)
    bgs = explain.kmeans_baselines(df, ["a", "b"], k=2)
    assert len(bgs) == 2
    local = explain.shap_local(model, df, bgs, ["a", "b"], n_samples=20)
    sums = local.groupBy("msno").agg(F.sum("shap_value").alias("s"), F.first("f_x").alias("fx"),
                                     F.first("f_baseline").alias("fb")).collect()
    assert len(sums) == 60 and all(abs(r.s - (r.fx - r.fb)) < 1e-9 for r in sums)


def test_domain_constraint_and_violation(spark):
    """Domains are rows: any number of values, and any text in them."""
    base = spark.createDataFrame([(i % 50, float(i), f"a,{i % 3}") for i in range(200)], "c int, x double, t string")
    prof = quality.profile_table(base, exact_distinct=True)
    doms = quality.category_domains(base, ["c", "t"])
    assert {(r.column, r.value) for r in doms.collect()} == {("c", str(i)) for i in range(50)} | {("t", f"a,{i}") for i in range(3)}
    assert {r.column for r in quality.category_domains(base).collect()} == {"t"}
    cur = spark.createDataFrame([(1, 1.0, "a,1"), (77, 2.0, "a"), (None, 3.0, None)], "c int, x double, t string")
    v = quality.drift_violations(prof, quality.profile_table(cur, exact_distinct=True), domains=doms, current_rows=cur)
    got = {(r.column, r.check): r.observed_value for r in v.collect()}
    assert got[("c", "domain")] == 1.0 and got[("t", "domain")] == 1.0 and ("x", "domain") not in got


def test_profile_of_every_type(spark):
    df = spark.sql("""SELECT * FROM VALUES (9007199254740992, 'x', DATE '2020-01-01', true), (9007199254740993, NULL, DATE '2021-01-01', true)
                      AS t(big, s, d, b)""")
    got = {r.column: r for r in quality.profile_table(df, exact_distinct=True).collect()}
    assert got["big"].n_distinct == 2 and got["s"].n_distinct == 1 and got["d"].n_distinct == 2 and got["b"].n_distinct == 1
    assert (got["d"].type, got["d"].min_text, got["d"].max_text) == ("date", "2020-01-01", "2021-01-01")
    assert got["s"].n_missing == 1 and got["s"].mean is None and got["big"].type == "bigint"
    other = df.withColumn("d", F.col("d").cast("string")).drop("b")
    bad = {(r.column, r.check) for r in quality.drift_violations(quality.profile_table(df), quality.profile_table(other)).collect()}
    assert ("d", "type") in bad and ("b", "missing_column") in bad


def test_curves_without_usable_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.6), (0, None), (0, float("nan")), (None, 0.5)], "is_churn int, score double")
    assert ev.auc_prob(df).first().auc == 1.0
    assert sorted(r.threshold for r in ev.roc_curve(df).collect()) == [0.1, 0.6, 0.9]
    assert tuple(ev.unusable_scores(df).first()) == (1, 1, 1)


def test_area_of_billions_of_rows(spark):
    n = 5_000_000_000
    rows = spark.createDataFrame([(n, n, n, 0, 2 * n, 2 * n), (n, n, 2 * n, 0, 2 * n, 2 * n)],
                                 "neg long, pos long, tp long, fp long, P long, N long")
    assert ev.auc_of(rows).first().auc == pytest.approx((0.5 * n * n + 1.5 * n * n) / (4.0 * n * n))


def test_undummy_levels_with_signs(spark):
    df = spark.createDataFrame([("1", "Young_Adult", "x"), ("2", "1.0", "y"), ("3", "a`b", "x_y")], "msno string, g string, g_h string")
    levels = prep.category_levels(df, ["g", "g_h"])
    back = prep.undummy(prep.one_hot(df, levels), ["g", "g_h"])
    assert sorted(map(tuple, back.select("msno", "g", "g_h").collect())) == sorted(map(tuple, df.collect()))


def test_csv_header_must_match(spark, tmp_path):
    from churnlab.sources import csv_io
    df = spark.createDataFrame([("1", "2")], "b string, a string")
    path = csv_io.write_csv(df, str(tmp_path / "x"))
    assert csv_io.read_csv(spark, path, df.schema).first().a == "2"
    with pytest.raises(Exception, match="(?i)header|field names"):
        csv_io.read_csv(spark, path, df.select("a", "b").schema).collect()


def test_asof_reads_only_earlier_months(spark, tmp_path):
    from churnlab.sources import feature_table as ft
    df = spark.sql("""SELECT cast(id % 5 AS string) AS msno, TIMESTAMP_NTZ '1998-01-15 00:00:00' + make_interval(0, cast(id % 6 AS int)) AS event_time,
                      id AS write_seq, id AS x, false AS deleted FROM range(60)""")
    ft.append_history(df, str(tmp_path / "h"))
    plan = ft.feature_dataset_asof(ft.read_history(spark, str(tmp_path / "h")), dt.datetime(1998, 3, 20), ["x"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in text and plan.count() == 5


def test_stamped(spark):
    from churnlab.sources.feature_table import stamped
    r = stamped(spark.range(1), at=dt.datetime(2024, 5, 6, 7, 8, 9)).first()
    assert r.event_time == dt.datetime(2024, 5, 6, 7, 8, 9) and r.event_time_iso == "2024-05-06T07:08:09.000Z"


def test_exact_quantiles_interpolate(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "a double")
    r = prep.exact_quantiles(df, ["a"], [0.25, 0.5, 0.75]).first()
    assert (r.q_0, r.q_1, r.q_2) == (1.75, 2.5, 3.25)


def test_feature_job_writes_three_splits(spark):
    import tempfile
    from churnlab.plans import features
    from churnlab.plans.job import write_splits
    from churnlab.schemas import FEATURES
    from conftest import SF_SMALL
    final = features.final(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="churnlab-job-", dir="/tmp")
    paths = write_splits(final, out, fmt="csv")
    total = sum(spark.read.schema(FEATURES).csv(p).count() for p in paths.values())
    assert total == final.count()


def test_history_append_splits_a_hot_key(spark):
    import tempfile
    from churnlab.sources import feature_table as ft
    ts = dt.datetime(2020, 5, 1)
    rows = [("hot", ts, i, i, False) for i in range(3000)] + [(f"k{i}", ts, i, i, False) for i in range(100)]
    h = spark.createDataFrame(rows, "msno string, event_time timestamp_ntz, write_seq int, v int, deleted boolean")
    path = tempfile.mkdtemp(prefix="churnlab-hist-", dir="/tmp") + "/h"
    ft.append_history(h, path, num_partitions=8)
    back = ft.read_history(spark, path)
    assert back.count() == 3100
    files = back.where("msno = 'hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1   # the hot key was written by several tasks


def test_facet_by_position(spark):
    rows = [("female", 1, 1.0), ("female", 0, 1.0), ("male", 1, 0.0), ("male", 0, 0.0)]
    df = spark.createDataFrame(rows, "gender string, is_churn int, prediction double")
    by_name = bias.posttraining_bias(df, facet="gender").first()
    by_pos = bias.posttraining_bias(df, facet=0).first()
    assert by_name == by_pos and by_name.dppl == -1.0


def test_churn_label_by_expiry(spark):
    from churnlab.operators.labels import churn_label_by_expiry
    d = dt.date
    rows = [("a", d(1998, 12, 1), d(1998, 12, 31)), ("a", d(1999, 1, 20), d(1999, 2, 20)),   # renewed in grace
            ("b", d(1998, 12, 1), d(1998, 12, 31)), ("b", d(1999, 3, 1), d(1999, 4, 1)),     # too late
            ("c", d(1998, 6, 1), d(1998, 7, 1)), ("c", d(1998, 12, 20), d(1999, 3, 20)),
            ("c", d(1999, 4, 1), d(1999, 5, 1))]                                              # last expiry counts
    df = spark.createDataFrame(rows, "msno string, t date, e date")
    got = {r.msno: r.is_churn for r in churn_label_by_expiry(df, "msno", "t", "e", d(1999, 1, 1)).collect()}
    assert got == {"a": 0, "b": 1, "c": 0}


def test_model_quality_violations(spark):
    b = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 1.0), (0, 0.0)], "is_churn int, prediction double")
    good = ev.rates(ev.confusion_matrix(b))
    bad = ev.rates(ev.confusion_matrix(spark.createDataFrame([(1, 0.0), (0, 1.0)], "is_churn int, prediction double")))
    assert ev.model_quality_violations(good, good).count() == 0
    assert {r.metric for r in ev.model_quality_violations(good, bad).collect()} == set(ev.QUALITY_METRICS)


class _Context:
    """A context without a configured folder."""

    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return {}

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master):
        self.sparkContext = _Context(master)


def test_checkpoint_dir_needs_a_shared_folder_on_a_cluster():
    from churnlab.session import checkpoint_dir

    local = _Session("local[4]")
    assert checkpoint_dir(local) == local.sparkContext.dir
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_dir(_Session(master))


def test_scratch_tables_are_dropped(spark):
    import os

    from churnlab import session

    df = session.cut_lineage(spark.range(10), "dropped")
    path = session._SCRATCH[-1][1]
    local = path.removeprefix("file:")
    assert df.count() == 10 and os.path.isdir(local)
    mine = [x for x in session._SCRATCH if x[1] != path]
    session._SCRATCH[:] = [x for x in session._SCRATCH if x[1] == path]
    assert session.drop_scratch(spark) == 1
    session._SCRATCH[:] = mine
    assert not os.path.exists(local)


def test_shap_linear_regression_exact(spark):
    """Linear model: KernelSHAP value = coefficient x (x - baseline)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from churnlab.operators import explain

    df = spark.range(40).select(F.col("id").cast("string").alias("msno"), (F.col("id") % 7).cast("double").alias("a"),
                                (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 3).cast("double").alias("c"))
    df = df.withColumn("y", 2 * F.col("a") - 3 * F.col("b") + 0.5 * F.col("c") + 1)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"),
                             LinearRegression(labelCol="y", regParam=0.0)]).fit(df)
    coef = dict(zip(["a", "b", "c"], model.stages[-1].coefficients.toArray()))
    base = {"a": 1.0, "b": 2.0, "c": 0.5}
    local = explain.shap_local(model, df, base, ["a", "b", "c"], n_samples=30, seed=7, output_col="prediction")
    x = {r.msno: r for r in df.collect()}
    for r in local.collect():
        expected = coef[r.feature] * (x[r.msno][r.feature] - base[r.feature])
        assert abs(r.shap_value - expected) < 1e-8


def test_first_row_baseline(spark):
    from churnlab.operators import explain
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0), ("c", 3.0)], "msno string, x double").repartition(3)
    assert explain.first_row_baseline(df, ["x"]) == {"x": 1.0}


def test_feature_job_cli(tmp_path):
    """The job runs as a module from the command line and writes three splits."""
    import os
    import subprocess
    import sys
    from conftest import SF_SMALL
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = str(tmp_path / "features")
    env = {**os.environ, "PYTHONPATH": repo}
    r = subprocess.run([sys.executable, "-m", "churnlab.plans.job", "--sf-dir", SF_SMALL, "--out", out],
                       cwd=repo, env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert {x for x in os.listdir(out) if x[0] not in "._"} == {"split=test", "split=train", "split=validation"}


def test_model_job_report_is_that_of_its_predictions(spark, tmp_path):
    """Features, fit, score, report and gate: the written report equals metrics
    counted in plain Python from the written predictions."""
    import json

    from conftest import SF_SMALL
    from churnlab.plans.job import run_model_job
    paths = run_model_job(spark, SF_SMALL, str(tmp_path), maxIter=3)
    rows = [r for r in spark.read.parquet(paths["predictions"]).collect() if r.split == "test"]
    tp = sum(r.is_churn == 1 and r.prediction == 1 for r in rows)
    tn = sum(r.is_churn == 0 and r.prediction == 0 for r in rows)
    pos, neg, named = sum(r.is_churn == 1 for r in rows), sum(r.is_churn == 0 for r in rows), sum(r.prediction == 1 for r in rows)
    report = json.loads(ev.read_report(spark, paths["report"]).first().report)["classification_metrics"]
    assert report["auc_score"]["value"] == pytest.approx((tp / pos + tn / neg) / 2)
    assert report["accuracy"]["value"] == pytest.approx(100 * (tp + tn) / len(rows), abs=0.006)
    assert report["recall"]["value"] == pytest.approx(100 * tp / pos, abs=0.006)
    assert report["precision"]["value"] == pytest.approx(100 * tp / max(1, named), abs=0.006)
    gate = ev.auc_gate(ev.read_report(spark, paths["report"])).first()
    assert gate.passed == (report["auc_score"]["value"] > 0.75) and all(0 <= r.score <= 1 for r in rows)


def test_shap_explains_every_row_with_a_repeated_id(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from churnlab.operators import explain
    df = spark.range(30).selectExpr("'u' AS msno", "cast(id AS double) AS a", "cast(id % 4 AS double) AS b", "cast(3 * id - id % 4 AS double) AS y")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LinearRegression(labelCol="y")]).fit(df)
    got = explain.shap_local(model, df, {"a": 0.0, "b": 0.0}, ["a", "b"], n_samples=12, output_col="prediction").collect()
    per: dict = {}
    for r in got:
        per.setdefault(r.row, []).append(r)
    assert len(per) == 30 and all(len(x) == 2 for x in per.values())
    assert all(abs(sum(r.shap_value for r in x) - (x[0].f_x - x[0].f_baseline)) < 1e-9 for x in per.values())
    assert len({round(x[0].f_x, 6) for x in per.values()}) == 30


def test_kmeans_baselines_keep_rows_with_missing_values(spark):
    from churnlab.operators import explain
    df = spark.createDataFrame([(0.0, 1.0), (None, 1.0), (10.0, None), (10.0, 3.0)], "a double, b double")
    assert len(explain.kmeans_baselines(df, ["a", "b"], k=2)) == 2


def test_one_hot_long_and_weights(spark):
    df = spark.createDataFrame([("1", "a", 0), ("2", None, 0), ("3", "b", 1), ("4", "a", 0)], "msno string, g string, is_churn int")
    assert sorted(map(tuple, prep.one_hot_long(df, ["g"]).collect())) == [("1", "g", "a"), ("3", "g", "b"), ("4", "g", "a")]
    weights = {r.msno: r.weight for r in prep.class_weights(df).collect()}
    assert weights == {"1": 1.0, "2": 1.0, "3": 3.0, "4": 1.0}
    assert sum(weights.values()) == prep.oversample(df).count()
    with pytest.raises(ValueError):
        prep.fit_string_indexer(spark.range(50).selectExpr("cast(id as string) as c"), ["c"], max_levels=10)
