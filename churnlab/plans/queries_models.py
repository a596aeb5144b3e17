"""Registered queries for the model family (M1-M4), SHAP.

Trained models are deterministic (fixed seeds) but their values depend on
MLlib, so only A13 has a SQL oracle; the rest are rows-only checks.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.operators import boosting, evaluation as ev, explain, model as mdl, tuning
from churnlab.plans import features
from churnlab.plans.job import run_model_job, split_frames
from churnlab.plans.oracle import with_views
from churnlab.plans.registry import register
from churnlab.schemas import CATEGORICAL_COLUMNS
from churnlab.session import cut_lineage
from churnlab.sources.csv_io import export_dir

NUMERIC_INPUTS = [c for c in mdl.FEATURE_INPUTS if c not in CATEGORICAL_COLUMNS]


def _frames(spark, sf_dir):
    """The splits of the final frame, written once: every fit reads them anew."""
    return split_frames(cut_lineage(features.final(spark, sf_dir), "final"))


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(mdl.feature_importances(mdl.train_gbt(_frames(spark, sf_dir)["train"])), schema)


@register("train_boosted")
def q_train_boosted(spark, sf_dir):
    """Every node of the second-order trees: depth 5, eta 0.2, gamma 4, min_child_weight 6, subsample 0.7, 50 rounds."""
    model = boosting.train_boosted(_frames(spark, sf_dir)["train"], mdl.FEATURE_INPUTS)
    return spark.createDataFrame(boosting.tree_rows(model), boosting.TREE_SCHEMA)


@register("score_boosted")
def q_score_boosted(spark, sf_dir):
    """Held-out rows scored by the second-order trees of ten rounds."""
    fr = _frames(spark, sf_dir)
    model = boosting.train_boosted(fr["train"], mdl.FEATURE_INPUTS, num_round=10)
    held_out = fr["test"].unionByName(fr["validation"])
    return boosting.score_boosted(model, held_out).select("msno", "split", "is_churn", "score", "prediction")


@register("loss_curve")
def q_loss_curve(spark, sf_dir):
    fr = _frames(spark, sf_dir)
    return mdl.loss_curve(mdl.train_gbt(fr["train"]), {"train": fr["train"], "test": fr["test"]})


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """Persist imputer + indexer + classifier as ONE unit on shared storage,
    reload it and score the raw held-out rows; label and prediction are kept
    with the input row's key."""
    return spark.read.parquet(run_model_job(spark, sf_dir, export_dir(spark, "model_job"))["predictions"])


@register("model_job_gate")
def q_model_job_gate(spark, sf_dir):
    """Features, fit, score, report as JSON, read back, gate: on the classifier's own predictions."""
    done = run_model_job(spark, sf_dir, export_dir(spark, "model_job"))
    return ev.auc_gate(ev.read_report(spark, done["report"]))


@register("model_job_quality")
def q_model_job_quality(spark, sf_dir):
    """Model quality of the classifier on the test rows against its validation rows."""
    scored = spark.read.parquet(run_model_job(spark, sf_dir, export_dir(spark, "model_job"))["predictions"])
    base, cur = (ev.rates(ev.confusion_matrix(scored.where(F.col("split") == x))) for x in ("validation", "test"))
    return ev.model_quality_report(base, cur)


@register("model_job_bias")
def q_model_job_bias(spark, sf_dir):
    """Post-training bias of the classifier's own predictions on held-out users, by gender."""
    from churnlab.operators import bias
    scored = spark.read.parquet(run_model_job(spark, sf_dir, export_dir(spark, "model_job"))["predictions"])
    facts = features.joined(spark, sf_dir).select("msno", "gender")
    return bias.posttraining_bias(scored.join(facts, "msno"), "is_churn", "prediction", "gender", ["female"])


@register("tune_gbt")
def q_tune_gbt(spark, sf_dir):
    fr = _frames(spark, sf_dir)
    return mdl.tune_gbt(fr["train"], fr["validation"])[0]


@register("tuned_scores")
def q_tuned_scores(spark, sf_dir):
    """Test rows scored by the winner of the search."""
    fr = _frames(spark, sf_dir)
    best = mdl.tune_gbt(fr["train"], fr["validation"])[1]
    return mdl.score(best, fr["test"]).select("msno", "is_churn", "score", "prediction")


@register("tune_hyperband")
def q_tune_hyperband(spark, sf_dir):
    """Six trials over the brackets of 1 to 10 rounds; a trial that goes on keeps its trees."""
    fr = _frames(spark, sf_dir)
    return tuning.hyperband(fr["train"], fr["validation"], mdl.FEATURE_INPUTS)[0]


@register("hyperband_scores")
def q_hyperband_scores(spark, sf_dir):
    """Test rows scored by the winner of the brackets."""
    fr = _frames(spark, sf_dir)
    winner = tuning.hyperband(fr["train"], fr["validation"], mdl.FEATURE_INPUTS)[1]
    return boosting.score_boosted(winner, fr["test"]).select("msno", "is_churn", "score", "prediction")


def _mode_sql(c):
    return (f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM final WHERE split = 'train' AND {c} IS NOT NULL "
            f"GROUP BY 1) m ORDER BY n DESC, v ASC LIMIT 1) AS {c}")


@register("shap_baseline", with_views(
    "SELECT " + ", ".join([_mode_sql(c) for c in CATEGORICAL_COLUMNS]
                          + [f"(SELECT avg({c}) FROM final WHERE split = 'train') AS {c}" for c in NUMERIC_INPUTS]),
    "final"), round_cols=tuple(NUMERIC_INPUTS))
def q_shap_baseline(spark, sf_dir):
    return explain.shap_baseline(_frames(spark, sf_dir)["train"], CATEGORICAL_COLUMNS, NUMERIC_INPUTS)


def _shap(spark, sf_dir, split="validation", kmeans=False):
    """Local values of a split's rows: against the training baseline row with 59
    samples, or against two k-means centres with 10."""
    fr = _frames(spark, sf_dir)
    trained = mdl.train_gbt(fr["train"])
    if kmeans:
        base, samples = explain.kmeans_baselines(fr["train"], mdl.FEATURE_INPUTS, k=2), 10
    else:
        base, samples = explain.shap_baseline(fr["train"], CATEGORICAL_COLUMNS, NUMERIC_INPUTS).first().asDict(), 59
    return explain.shap_local(trained, fr[split], base, mdl.FEATURE_INPUTS, "msno", n_samples=samples, seed=123)


@register("shap_local")
def q_shap_local(spark, sf_dir):
    return _shap(spark, sf_dir)


@register("shap_kmeans")
def q_shap_kmeans(spark, sf_dir):
    return _shap(spark, sf_dir, kmeans=True)


@register("shap_global")
def q_shap_global(spark, sf_dir):
    return explain.shap_global(_shap(spark, sf_dir))


@register("bias_flip_test")
def q_bias_flip_test(spark, sf_dir):
    """Held-out rows with gender 'female' re-scored as 'male' (indices from the
    fitted indexer)."""
    from churnlab.operators import bias
    parts = features.final_parts(spark, sf_dir)
    idx = parts["indexer"]
    labels = dict(zip(idx.getInputCols(), idx.labelsArray))["gender"]
    fr = split_frames(cut_lineage(parts["final"], "final"))
    held_out = fr["test"].unionByName(fr["validation"])
    return bias.flip_test(mdl.train_gbt(fr["train"]), held_out, "gender", [float(labels.index("female"))],
                          float(labels.index("male")))
