"""Registered queries for the evaluation family (M5-M12, S7, S8) on the
deterministic ``predictions`` view."""

from __future__ import annotations


from pyspark.sql import functions as F

from churnlab.operators import evaluation as ev
from churnlab.plans.oracle import with_views
from churnlab.plans.registry import register
from churnlab.sources import adapters

_CM = """SELECT count(*) FILTER (WHERE is_churn = 0 AND prediction = 0) AS tn,
       count(*) FILTER (WHERE is_churn = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE is_churn = 1 AND prediction = 0) AS fn,
       count(*) FILTER (WHERE is_churn = 1 AND prediction = 1) AS tp FROM predictions"""

_RATES = f"""SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
       coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0) AS accuracy,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
       tp / nullif(tp + fn, 0) AS tpr, tn / nullif(tn + fp, 0) AS tnr FROM ({_CM}) c"""

_REPORT = f"""SELECT (tpr + tnr) / 2 AS auc_score, round(recall * 100, 2) AS recall, round(precision * 100, 2) AS precision,
       round(accuracy * 100, 2) AS accuracy, round(f1 * 100, 2) AS f1 FROM ({_RATES}) r"""

_CUM = """SELECT threshold, pos, neg,
       sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
       sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
       sum(pos) OVER () AS P, sum(neg) OVER () AS N
FROM (SELECT CAST(score AS DOUBLE) AS threshold, count(*) FILTER (WHERE is_churn = 1) AS pos,
             count(*) FILTER (WHERE is_churn = 0) AS neg FROM predictions GROUP BY 1) s"""


def _preds(spark, sf_dir):
    return adapters.predictions(spark, sf_dir)


@register("label_at_threshold", with_views("""
SELECT msno, CAST(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label_050,
       CAST(CASE WHEN score >= 0.8 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label_080 FROM predictions""", "predictions"))
def q_label_at_threshold(spark, sf_dir):
    p = _preds(spark, sf_dir)
    p = ev.label_at_threshold(p, "score", 0.5, "label_050")
    return ev.label_at_threshold(p, "score", 0.8, "label_080").select("msno", "label_050", "label_080")


@register("confusion_matrix", with_views(_CM, "predictions"))
def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_preds(spark, sf_dir))


@register("roc_curve", with_views(
    f"SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / P AS tpr, fp / N AS fpr FROM ({_CUM}) c",
    "predictions"), round_cols=("tpr", "fpr"))
def q_roc_curve(spark, sf_dir):
    return ev.roc_curve(_preds(spark, sf_dir))


@register("pr_curve", with_views(
    f"SELECT threshold, tp / nullif(tp + fp, 0) AS precision, tp / P AS recall FROM ({_CUM}) c", "predictions"),
    round_cols=("precision", "recall"))
def q_pr_curve(spark, sf_dir):
    return ev.pr_curve(_preds(spark, sf_dir))


@register("auc_prob", with_views(
    f"SELECT CAST(sum(neg * (2 * tp - pos)) AS DOUBLE) / (2.0 * any_value(P) * any_value(N)) AS auc FROM ({_CUM}) c",
    "predictions"), round_cols=("auc",))
def q_auc_prob(spark, sf_dir):
    return ev.auc_prob(_preds(spark, sf_dir))


@register("eval_report", with_views(_REPORT, "predictions"), round_cols=("auc_score",))
def q_eval_report(spark, sf_dir):
    return ev.eval_report(_preds(spark, sf_dir))


@register("auc_gate", with_views(f"""
SELECT auc_score, CAST(0.75 AS DOUBLE) AS threshold, coalesce(auc_score > 0.75, false) AS passed FROM ({_REPORT}) r""",
    "predictions"), round_cols=("auc_score",))
def q_auc_gate(spark, sf_dir):
    return ev.auc_gate(ev.report_json(ev.eval_report(_preds(spark, sf_dir))))


@register("model_quality", with_views(f"""
SELECT tn, fp, fn, tp, accuracy, precision, recall, f1, tpr, tnr, (tpr + tnr) / 2 AS auc_hard FROM ({_RATES}) r""",
    "predictions"), round_cols=("accuracy", "precision", "recall", "f1", "tpr", "tnr", "auc_hard"))
def q_model_quality(spark, sf_dir):
    return ev.rates(ev.confusion_matrix(_preds(spark, sf_dir)))


def _rates_sql(where):
    return f"""SELECT *, (tpr + tnr) / 2 AS auc_hard FROM (
SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
       coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0) AS accuracy,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
       tp / nullif(tp + fn, 0) AS tpr, tn / nullif(tn + fp, 0) AS tnr
FROM (SELECT count(*) FILTER (WHERE is_churn = 0 AND prediction = 0) AS tn,
             count(*) FILTER (WHERE is_churn = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE is_churn = 1 AND prediction = 0) AS fn,
             count(*) FILTER (WHERE is_churn = 1 AND prediction = 1) AS tp
      FROM predictions WHERE {where}) c) r"""


_SPLIT200 = "CAST(('0x' || substr(md5(msno || '|200'), 1, 8)) AS BIGINT) % 1000000"
_MQ_TOL = 0.05


_MQ_BODY = (f"SELECT *, coalesce(observed_value < baseline_value - {_MQ_TOL}, false) AS violated FROM ("
            + " UNION ALL ".join(
                f"SELECT '{m}' AS metric, b.{m} AS baseline_value, c.{m} AS observed_value "
                f"FROM ({_rates_sql(_SPLIT200 + ' < 700000')}) b, ({_rates_sql(_SPLIT200 + ' >= 700000')}) c"
                for m in ev.QUALITY_METRICS) + ") v")


@register("model_quality_check", with_views(_MQ_BODY, "predictions"), round_cols=("baseline_value", "observed_value"))
def q_model_quality_check(spark, sf_dir):
    """Q5 check: quality on held-out users (split != train) against the
    training users' baseline; a metric is violated when it fell by more than 0.05."""
    from churnlab.operators.prep import split_assign
    p = split_assign(_preds(spark, sf_dir))
    base = ev.rates(ev.confusion_matrix(p.where(F.col("split") == "train")))
    cur = ev.rates(ev.confusion_matrix(p.where(F.col("split") != "train")))
    return ev.model_quality_report(base, cur, _MQ_TOL)
