
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from churnlab.operators import bias, evaluation as ev, prep

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from(["a", "b", "c", "d"])), min_size=1, max_size=60))
def test_oversampling_keeps_majority_and_splits_are_exact(spark, rows):
    df = spark.createDataFrame([(str(i), y, g) for i, (y, g) in enumerate(rows)], "msno string, is_churn int, g string")
    over = prep.oversample(df)
    assert over.where("is_churn = 0").count() == df.where("is_churn = 0").count()
    s = prep.split_assign(df)
    assert s.count() == df.count() and s.select("msno").distinct().count() == df.count()
    assert {r.split for r in s.collect()} <= {"train", "test", "validation"}


@settings(**SETTINGS)
@given(st.lists(st.sampled_from(["x", "y", "z", "w"]), min_size=1, max_size=40))
def test_indices_dense_by_frequency_and_one_hot_round_trip(spark, values):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "msno string, g string")
    model = prep.fit_string_indexer(df, ["g"])
    idx = {r.g: r.i for r in prep.string_index(df.withColumn("orig", F.col("g")), model, ["g"])
           .select(F.col("orig").alias("g"), F.col("g").alias("i")).distinct().collect()}
    assert sorted(idx.values()) == list(range(len(idx)))
    freq = {v: values.count(v) for v in set(values)}
    order = sorted(freq, key=lambda v: (-freq[v], v))
    assert [idx[v] for v in order] == list(range(len(order)))
    hot = prep.one_hot(df, prep.category_levels(df, ["g"]))
    back = {r.msno: r.g for r in prep.undummy(hot, ["g"]).collect()}
    assert back == {str(i): v for i, v in enumerate(values)}


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1)), min_size=2, max_size=50))
def test_hard_auc_is_mean_of_tpr_tnr_and_identical_facets_unbiased(spark, rows):
    df = spark.createDataFrame([(y, float(p)) for y, p in rows], "is_churn int, prediction double")
    r = ev.rates(ev.confusion_matrix(df)).first()
    rep = ev.eval_report(df).first()
    if r.tpr is not None and r.tnr is not None:
        assert abs(rep.auc_score - (r.tpr + r.tnr) / 2) < 1e-12
    both = df.withColumn("gender", F.lit("female")).unionByName(df.withColumn("gender", F.lit("male")))
    pre = bias.pretraining_bias(both).first()
    assert pre.ci == 0 and pre.dpl == 0 and pre.tvd == 0 and pre.ks == 0
    assert pre.kl in (0, None)
    post = bias.posttraining_bias(both).first()
    assert post.dppl == 0 and post.di in (1, None)


def test_model_beats_majority_baseline(spark):
    from conftest import SF_ORACLE
    from churnlab.plans import queries_models as qm
    from churnlab.operators import model as mdl
    fr = qm._frames(spark, SF_ORACLE)
    m = mdl.train_gbt(fr["train"])
    scored = mdl.score(m, fr["test"].unionByName(fr["validation"]))
    assert ev.auc_prob(scored).first().auc > 0.5   # majority-class baseline scores 0.5
    assert scored.count() == fr["test"].count() + fr["validation"].count()
    curve = mdl.loss_curve(m, {"train": fr["train"]}).orderBy("iteration").collect()
    assert len(curve) == 50 and curve[-1].logloss < curve[0].logloss


def test_saved_scoring_unit_equals_scoring_prepared_rows(spark, tmp_path):
    """Raw rows through the persisted unit == prepared rows through the classifier."""
    from conftest import SF_ORACLE
    from churnlab.operators import model as mdl
    from churnlab.plans import features
    from churnlab.plans.job import run_model_job, split_frames
    path = run_model_job(spark, SF_ORACLE, str(tmp_path), maxIter=5)["predictions"]
    unit_scores = {(r.msno, r.split): (r.score, r.prediction) for r in spark.read.parquet(path).collect()}
    fr = split_frames(features.final(spark, SF_ORACLE))
    direct = mdl.score(mdl.train_gbt(fr["train"], maxIter=5), fr["test"].unionByName(fr["validation"]))
    got = {(r.msno, r.split): (r.score, r.prediction) for r in direct.select("msno", "split", "score", "prediction").collect()}
    assert got.keys() == unit_scores.keys()
    assert all(abs(got[k][0] - unit_scores[k][0]) < 1e-12 and got[k][1] == unit_scores[k][1] for k in got)


def test_tuning_successive_halving(spark):
    from conftest import SF_SMALL
    from churnlab.plans import queries_models as qm
    from churnlab.operators import model as mdl
    fr = qm._frames(spark, SF_SMALL)
    table, winner = mdl.tune_gbt(fr["train"], fr["validation"], n_trials=4, parallel=2, min_iter=1, max_iter=4, eta=2)
    rows = table.collect()
    final = [r for r in rows if r.best and r.rung == max(x.rung for x in rows)][0]
    assert winner.stages[-1].getNumTrees == final.max_iter
    assert mdl._logloss(winner, fr["validation"], "is_churn") == pytest.approx(final.val_logloss, rel=1e-9)
    by_rung = {}
    for r in rows:
        by_rung.setdefault(r.rung, []).append(r)
    rungs = sorted(by_rung)
    assert [len(by_rung[k]) for k in rungs] == [4, 2, 1]          # halving of survivors
    assert [by_rung[k][0].max_iter for k in rungs] == [1, 2, 4]    # growing budget
    best = {r.trial for r in rows if r.best}
    assert len(best) == 1 and best == {by_rung[rungs[-1]][0].trial}
    assert all(1 <= r.max_depth <= 10 and 0 < r.step_size < 1 for r in rows)


def test_txn_features_hot_user_matches_brute_force(spark):
    """One user holding a third of all transactions: the fused aggregate agrees
    with a direct computation (smallest value on mode ties)."""
    from collections import Counter
    from conftest import SF_ORACLE
    from churnlab.sources import adapters
    from churnlab.operators.transactions import txn_features
    t = adapters.transactions(spark, SF_ORACLE)
    hot = t.withColumn("msno", F.when(F.xxhash64("transaction_date", "actual_amount_paid") % 3 == 0,
                                      F.lit("hot")).otherwise(F.col("msno")))
    got = txn_features(hot).where("msno = 'hot'").first()
    rows = hot.where("msno = 'hot'").toPandas()

    def mode(values):
        c = Counter(v for v in values if v is not None)
        top = max(c.values())
        return min(v for v, n in c.items() if n == top)

    quarters = [(int(str(d)[4:6]) - 1) // 3 + 1 for d in rows["transaction_date"]]
    assert got.regist_trans == len(rows)
    assert got.revenue == int(rows["actual_amount_paid"].sum())
    assert got.regist_cancels == int(rows["is_cancel"].sum())
    assert got.mst_frq_pay_met == mode(rows["payment_method_id"])
    assert got.mst_frq_plan_days == mode(rows["payment_plan_days"])
    assert got.is_auto_renew == mode(rows["is_auto_renew"])
    assert got.qtr_trans == mode(quarters)
