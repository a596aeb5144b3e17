"""Labels at a threshold, confusion counts, curves, AUCs, report, gate.

Everything is an aggregate over (truth, prediction/score). Curves aggregate
by distinct score first (map-side combine) and then use sliced running sums,
never a global single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions import ratio, ratio_or_zero
from churnlab.functions.running import running_totals

# Fixed value: quality gate, hard-label AUC strictly above this.
AUC_GATE = 0.75


def label_at_threshold(df: DataFrame, score: str = "score", threshold: float = 0.5,
                       out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.when(F.col(score) >= F.lit(threshold), 1.0).otherwise(0.0))


def confusion_matrix(df: DataFrame, truth: str = "is_churn", pred: str = "prediction") -> DataFrame:
    y, p = F.col(truth), F.col(pred)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def rates(cm: DataFrame) -> DataFrame:
    """Add accuracy/precision/recall/f1/tpr/tnr/hard-label AUC (fractions)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = ratio_or_zero(tp, tp + fp)
    recall = ratio_or_zero(tp, tp + fn)
    return cm.withColumns({
        "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        "tpr": ratio(tp, tp + fn),
        "tnr": ratio(tn, tn + fp),
    }).withColumn("auc_hard", (F.col("tpr") + F.col("tnr")) / 2)


def eval_report(df: DataFrame, truth: str = "is_churn", pred: str = "prediction") -> DataFrame:
    """The evaluation report: hard-label AUC (unrounded, 0-1) and
    recall/precision/accuracy/F1 as percentages rounded to 2 places."""
    r = rates(confusion_matrix(df, truth, pred))
    return r.select(
        F.col("auc_hard").alias("auc_score"),
        F.round(F.col("recall") * 100, 2).alias("recall"),
        F.round(F.col("precision") * 100, 2).alias("precision"),
        F.round(F.col("accuracy") * 100, 2).alias("accuracy"),
        F.round(F.col("f1") * 100, 2).alias("f1"),
    )


def report_json(report: DataFrame) -> DataFrame:
    """Nested ``classification_metrics.<metric>.value`` document, one JSON string."""
    metrics = F.struct(*[F.struct(F.col(m).alias("value")).alias(m)
                         for m in ("auc_score", "recall", "precision", "accuracy", "f1")])
    return report.select(F.to_json(F.struct(metrics.alias("classification_metrics"))).alias("report"))


def write_report(report: DataFrame, path: str) -> None:
    report_json(report).write.mode("overwrite").text(path)


def read_report(spark, path: str) -> DataFrame:
    """The written document, one row (``report``)."""
    return spark.read.text(path).select(F.col("value").alias("report"))


def auc_gate(report_doc: DataFrame, threshold: float = AUC_GATE,
             path: str = "$.classification_metrics.auc_score.value") -> DataFrame:
    """Read one JSON path of the report and test it STRICTLY above the threshold."""
    v = F.get_json_object(F.col("report"), path).cast("double")
    return report_doc.select(v.alias("auc_score"), F.lit(threshold).alias("threshold"),
                             F.coalesce(v > F.lit(threshold), F.lit(False)).alias("passed"))


def unusable_scores(df: DataFrame, truth: str = "is_churn", score: str = "score") -> DataFrame:
    """One row: how many rows the curves leave out, for want of a score, because
    it is not a number, or for want of a label 0 or 1."""
    s, y = F.col(score).cast("double"), F.col(truth)
    return df.agg(F.count_if(s.isNull()).alias("null_score"), F.count_if(F.isnan(s)).alias("nan_score"),
                  F.count_if(y.isNull() | ~y.isin(0, 1)).alias("no_label"))


def _score_counts(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Rows without a usable score or label are left out (``unusable_scores`` counts them)."""
    s = F.col(score).cast("double")
    return df.where(s.isNotNull() & ~F.isnan(s) & F.col(truth).isin(0, 1)).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg"))


def _cumulative(df: DataFrame, truth: str, score: str) -> DataFrame:
    """One row per distinct score: tp/fp = positives/negatives scored >= it."""
    counts = _score_counts(df, truth, score).withColumn("_desc", -F.col("threshold"))
    cum = running_totals(counts, "_desc", ["pos", "neg"])
    return cum.select("threshold", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                      F.col("all_pos").alias("P"), F.col("all_neg").alias("N"))


def roc_curve(df: DataFrame, truth: str = "is_churn", score: str = "score") -> DataFrame:
    """(threshold, tp, fp, tpr, fpr) at every distinct score, no points dropped."""
    c = _cumulative(df, truth, score)
    return c.select("threshold", "tp", "fp", ratio("tp", "P").alias("tpr"), ratio("fp", "N").alias("fpr"))


def pr_curve(df: DataFrame, truth: str = "is_churn", score: str = "score") -> DataFrame:
    c = _cumulative(df, truth, score)
    return c.select("threshold", ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
                    ratio("tp", "P").alias("recall"))


def auc_prob(df: DataFrame, truth: str = "is_churn", score: str = "score") -> DataFrame:
    """Trapezoid area under the ROC curve from (0,0), exact with ties:
    sum over distinct scores of neg * (tp_before + tp_after) / 2, over P*N."""
    return auc_of(_cumulative(df, truth, score))


def auc_of(cumulative: DataFrame) -> DataFrame:
    """The area from (neg, pos, tp, P, N) rows. Products of counts exceed a long
    from some 2e9 rows a class, so they are decimals."""
    big = lambda c: c.cast("decimal(19,0)")
    area = F.sum((big(F.col("neg")) * big(2 * F.col("tp") - F.col("pos"))).cast("decimal(38,0)"))
    return cumulative.agg(F.try_divide(area.cast("double"), F.lit(2.0) * F.first("P").cast("double") * F.first("N").cast("double")).alias("auc"))


QUALITY_METRICS = ("accuracy", "precision", "recall", "f1", "auc_hard")


def model_quality_report(baseline: DataFrame, current: DataFrame, tolerance: float = 0.05,
                         metrics: tuple[str, ...] = QUALITY_METRICS) -> DataFrame:
    """Q5 check: (metric, baseline_value, observed_value, violated) per metric
    of ``rates``; violated = fell by more than ``tolerance`` below the
    baseline. Both inputs are one-row ``rates`` frames; baseline values enter
    as scalar subqueries."""
    base = {m: baseline.select(F.col(m)).scalar() for m in metrics}
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), base[m].alias("baseline_value"),
                              F.col(m).alias("observed_value")) for m in metrics])
    out = current.select(F.inline(rows))
    return out.withColumn("violated", F.coalesce(
        F.col("observed_value") < F.col("baseline_value") - F.lit(tolerance), F.lit(False)))


def model_quality_violations(baseline: DataFrame, current: DataFrame, tolerance: float = 0.05,
                             metrics: tuple[str, ...] = QUALITY_METRICS) -> DataFrame:
    return model_quality_report(baseline, current, tolerance, metrics).where("violated").drop("violated")
