"""Q6-Q13, Q15: pre- and post-training bias metrics.

Facet d = rows whose facet value is in ``facet_values``; a = all other rows
(NULL facet included). Label value 1 is the positive outcome. Every metric
comes from ONE aggregate of a handful of counts; a zero denominator or an
empty facet gives NULL, never an error. Formulas follow the published
definitions (class imbalance, label-proportion difference, KL/JS divergence,
Lp norm, total variation, Kolmogorov-Smirnov, conditional demographic
disparity, and the confusion-matrix differences).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.functions import ratio
from churnlab.session import cut_lineage


def _in_facet(facet: str, values: list) -> Column:
    return F.coalesce(F.col(facet).isin(values), F.lit(False))


def facet_column(df: DataFrame, facet) -> str:
    """A facet is given by name or by 0-based column position (headerless data)."""
    return df.columns[facet] if isinstance(facet, int) else facet


def _kl_term(p: Column, q: Column) -> Column:
    return F.when(p == 0, F.lit(0.0)).when(q == 0, F.lit(None).cast("double")).otherwise(p * F.ln(p / q))


def label_counts(df: DataFrame, label: str, facet: str, facet_values: list) -> DataFrame:
    d, y = _in_facet(facet, facet_values), F.col(label)
    return df.agg(
        F.count_if(~d & (y == 1)).alias("n_a1"), F.count_if(~d & (y == 0)).alias("n_a0"),
        F.count_if(d & (y == 1)).alias("n_d1"), F.count_if(d & (y == 0)).alias("n_d0"))


def pretraining_bias(df: DataFrame, label: str = "is_churn", facet: str = "gender",
                     facet_values: list = ("female",)) -> DataFrame:
    c = label_counts(df, label, facet_column(df, facet), list(facet_values))
    n_a = F.col("n_a1") + F.col("n_a0")
    n_d = F.col("n_d1") + F.col("n_d0")
    qa, qd = ratio("n_a1", n_a), ratio("n_d1", n_d)
    pa = [1 - qa, qa]
    pd = [1 - qd, qd]
    m = [(x + y) / 2 for x, y in zip(pa, pd)]
    kl = lambda p, q: _kl_term(p[0], q[0]) + _kl_term(p[1], q[1])
    diff = [x - y for x, y in zip(pa, pd)]
    return c.select(
        n_a.alias("n_a"), n_d.alias("n_d"),
        ratio(n_a - n_d, n_a + n_d).alias("ci"),
        (qa - qd).alias("dpl"),
        kl(pa, pd).alias("kl"),
        ((kl(pa, m) + kl(pd, m)) / 2).alias("js"),
        F.sqrt(diff[0] * diff[0] + diff[1] * diff[1]).alias("lp"),
        ((F.abs(diff[0]) + F.abs(diff[1])) / 2).alias("tvd"),
        F.greatest(F.abs(diff[0]), F.abs(diff[1])).alias("ks"),
    )


def conditional_demographic_disparity(df: DataFrame, label: str, facet: str, facet_values: list,
                                      group: str) -> DataFrame:
    """Size-weighted mean over groups of DD = n_d0/n0 - n_d1/n1 (a term whose
    label class is empty in the group counts as 0). Two aggregates: per group
    (map-side combined), then global."""
    d, y = _in_facet(facet_column(df, facet), list(facet_values)), F.col(label)
    per = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"),
        F.count_if(d & (y == 0)).alias("nd0"), F.count_if(d & (y == 1)).alias("nd1"))
    dd = F.coalesce(ratio("nd0", "n0"), F.lit(0.0)) - F.coalesce(ratio("nd1", "n1"), F.lit(0.0))
    return per.agg(F.try_divide(F.sum(F.col("n") * dd), F.sum("n").cast("double")).alias("cdd"))


def posttraining_bias(df: DataFrame, label: str = "is_churn", pred: str = "prediction", facet: str = "gender",
                      facet_values: list = ("female",)) -> DataFrame:
    d, y, p = _in_facet(facet_column(df, facet), list(facet_values)), F.col(label), F.col(pred)
    aggs = []
    for name, f in (("a", ~d), ("d", d)):
        aggs += [F.count_if(f & (y == 1) & (p == 1)).alias(f"tp_{name}"),
                 F.count_if(f & (y == 0) & (p == 1)).alias(f"fp_{name}"),
                 F.count_if(f & (y == 1) & (p == 0)).alias(f"fn_{name}"),
                 F.count_if(f & (y == 0) & (p == 0)).alias(f"tn_{name}")]
    c = df.agg(*aggs)
    g = {k: F.col(k) for k in c.columns}

    def side(s):
        tp, fp, fn, tn = g[f"tp_{s}"], g[f"fp_{s}"], g[f"fn_{s}"], g[f"tn_{s}"]
        n = tp + fp + fn + tn
        return dict(tp=tp, fp=fp, fn=fn, tn=tn, n=n, obs1=tp + fn, obs0=tn + fp, pred1=tp + fp, pred0=tn + fn)

    a, b = side("a"), side("d")
    qa, qd = ratio(a["pred1"], a["n"]), ratio(b["pred1"], b["n"])
    return c.select(
        (qa - qd).alias("dppl"),
        F.try_divide(qd, qa).alias("di"),
        (ratio(a["obs1"], a["pred1"]) - ratio(b["obs1"], b["pred1"])).alias("dcacc"),
        (ratio(b["obs0"], b["pred0"]) - ratio(a["obs0"], a["pred0"])).alias("dcr"),
        (ratio(a["tp"], a["obs1"]) - ratio(b["tp"], b["obs1"])).alias("rd"),
        (ratio(a["tp"], a["pred1"]) - ratio(b["tp"], b["pred1"])).alias("dar"),
        (ratio(b["tn"], b["pred0"]) - ratio(a["tn"], a["pred0"])).alias("drr"),
        (ratio(a["tp"] + a["tn"], a["n"]) - ratio(b["tp"] + b["tn"], b["n"])).alias("ad"),
        (ratio(b["fn"], b["fp"]) - ratio(a["fn"], a["fp"])).alias("te"),
        (ratio(a["tn"], a["obs0"]) - ratio(b["tn"], b["obs0"])).alias("sd"),
    )


def flip_test(model, rows: DataFrame, facet: str, facet_values: list, counterfactual_value,
              pred: str = "prediction") -> DataFrame:
    """Q14 counterfactual flip test: each facet-d row is scored as is and with
    its facet value replaced by ``counterfactual_value`` (facet a); FT =
    (#(0 -> 1) - #(1 -> 0)) / n_d. Two narrow ``transform`` passes over the
    same rows, no pairing of rows, so it is exact and linear in n_d."""
    d = rows.where(_in_facet(facet, list(facet_values)))
    extra = ("features", "rawPrediction", "probability", pred)
    base_cols = [c for c in d.columns if c not in extra]
    first = model.transform(d.select(*base_cols)).select(*base_cols, F.col(pred).alias("_p0"))
    swapped = first.withColumn(facet, F.lit(counterfactual_value).cast(d.schema[facet].dataType))
    second = model.transform(swapped).select("_p0", F.col(pred).alias("_p1"))
    c = second.agg(F.count(F.lit(1)).alias("n_d"),
                   F.count_if((F.col("_p0") == 0) & (F.col("_p1") == 1)).alias("n_up"),
                   F.count_if((F.col("_p0") == 1) & (F.col("_p1") == 0)).alias("n_down"))
    return c.withColumn("ft", ratio(F.col("n_up") - F.col("n_down"), "n_d"))


def nearest_pairs(df: DataFrame, features: list[str], key: str = "msno", pred: str = "prediction", facet: str = "gender",
                  facet_values: list = ("female",), steps: int = 1000, **options) -> DataFrame:
    """One row per facet-d row: its key and prediction, the nearest facet-a row (key
    ``near``, prediction ``near_pred``) and the squared distance ``d2`` over the
    standardised features on a grid of ``steps`` to a standard deviation."""
    from churnlab.operators.nearest import nearest_points, on_grid

    d = _in_facet(facet_column(df, facet), list(facet_values))
    rows = on_grid(df, features, "v", steps).select(F.col(key).cast("string").alias("key"), F.col(pred).cast("double").alias("value"), "v", d.alias("d"))
    rows = cut_lineage(rows, "points")
    asked = rows.where("d")
    found = nearest_points(asked, rows.where("NOT d"), **options).select("v", "d2", F.col("key").alias("near"), F.col("value").alias("near_pred"))
    return asked.join(found, "v", "left").select(F.col("key").alias(key), F.col("value").alias(pred), "near", "near_pred", "d2")


def flip_test_nearest(df: DataFrame, features: list[str], key: str = "msno", pred: str = "prediction", facet: str = "gender",
                      facet_values: list = ("female",), **options) -> DataFrame:
    """Q14 flip test: FT = (d rows predicted 0 whose nearest a row is predicted 1, less
    the reverse) / n_d. Nearest rows are exact; equally near ones: the smallest key."""
    p, q = F.col(pred), F.col("near_pred")
    pairs = nearest_pairs(df, features, key, pred, facet, facet_values, **options)
    c = pairs.agg(F.count(F.lit(1)).alias("n_d"), F.count_if((p == 0) & (q == 1)).alias("n_up"), F.count_if((p == 1) & (q == 0)).alias("n_down"))
    return c.withColumn("ft", ratio(F.col("n_up") - F.col("n_down"), "n_d"))
