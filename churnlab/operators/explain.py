"""SHAP baseline row, KernelSHAP local values, global importance.

KernelSHAP per row x with baseline b: coalition masks z (seeded, shared by all
rows; the all-ones and all-zeros masks are always included) give blended inputs
z*x + (1-z)*b; the model scores all of them in one distributed
``model.transform``. The least-squares fit of f(z) - f(b) on the masks, under the
efficiency constraint sum(phi) = f(x) - f(b), is linear in the scores and has one
matrix for all rows: it is computed once, and a row's values are weighted sums of
its scores, which Spark aggregates before any shuffle.

The mask expansion is a per-row ``explode`` by a fixed, parameter-bounded factor
(no join). Each input row is explained by itself, also where ids repeat.
"""

from __future__ import annotations


import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.session import cut_lineage


def shap_baseline(train: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """One row: smallest mode of each categorical, mean of each numeric."""
    return train.agg(*[F.mode(c, deterministic=True).alias(c) for c in categorical],
                     *[F.avg(c).alias(c) for c in numeric])


def first_row_baseline(train: DataFrame, features: list[str], key: str = "msno") -> dict:
    """The 'first row' baseline, made deterministic: the row with the smallest
    key (a distributed top-1, no sort of the whole frame)."""
    row = train.orderBy(F.col(key).asc()).limit(1).select(*features).first()
    return row.asDict() if row else {}


def kmeans_baselines(train: DataFrame, features: list[str], k: int = 2, seed: int = 123) -> list[dict]:
    """``k`` background rows: MLlib k-means centres of the training rows
    (k is a parameter, so only k small rows reach the driver). A missing value
    counts as its column's mean, so every row takes part."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    means = train.agg(*[F.avg(f).alias(f) for f in features]).first().asDict()
    filled = train.select(*[F.coalesce(F.col(f).cast("double"), F.lit(means[f] or 0.0)).alias(f) for f in features])
    vec = VectorAssembler(inputCols=features, outputCol="_v").transform(filled)
    centres = KMeans(k=k, seed=seed, featuresCol="_v").fit(vec).clusterCenters()
    return [dict(zip(features, map(float, c))) for c in centres]


def sample_masks(n_features: int, n_samples: int, seed: int) -> np.ndarray:
    """Coalitions drawn from the Shapley kernel: size s with probability
    proportional to (M-1)/(s(M-s)), then a uniform subset of that size."""
    rng = np.random.default_rng(seed)
    m = n_features
    masks = [np.ones(m, dtype=np.int8), np.zeros(m, dtype=np.int8)]
    if m > 1:
        sizes = np.arange(1, m)
        p = (m - 1) / (sizes * (m - sizes))
        p = p / p.sum()
        for _ in range(n_samples):
            s = rng.choice(sizes, p=p)
            z = np.zeros(m, dtype=np.int8)
            z[rng.choice(m, size=s, replace=False)] = 1
            masks.append(z)
    return np.stack(masks)


def solution(masks: np.ndarray) -> np.ndarray:
    """C with phi = C @ f for the scores f of the masks (f[0]: the row itself,
    f[1]: the baseline): least squares under sum(phi) = f[0] - f[1], the last
    coefficient eliminated."""
    n, m = masks.shape
    out = np.zeros((m, n))
    z = masks[2:].astype(float)
    if m > 1 and len(z):
        inverse = np.linalg.pinv(z[:, :-1] - z[:, [-1]])
        out[:-1, 2:] = inverse
        out[:-1, 0] = -inverse @ z[:, -1]
        out[:-1, 1] = inverse @ (z[:, -1] - 1)
    delta = np.zeros(n)
    delta[:2] = 1, -1
    out[-1] = delta - out[:-1].sum(axis=0)
    return out


def shap_local(model: PipelineModel, rows: DataFrame, baseline, features: list[str], id_col: str = "msno",
               n_samples: int = 59, seed: int = 123, score_index: int = 1,
               output_col: str = "probability") -> DataFrame:
    """(id, row, feature, shap_value, f_x, f_baseline) for every input row; ``row``
    numbers the rows, whatever their ids.

    ``baseline`` is one row (dict) or a small background set (list of dicts,
    e.g. ``kmeans_baselines``); with several, f(z) is the mean over them. The
    explained output is ``output_col[score_index]`` for a vector column (class
    probability) or ``output_col`` itself for a numeric one (regression)."""
    backgrounds = baseline if isinstance(baseline, list) else [baseline]
    masks = sample_masks(len(features), n_samples, seed)
    weights = solution(masks) / len(backgrounds)
    # Written out with their numbers, so that a task run anew numbers the same rows.
    numbered = cut_lineage(rows.select(id_col, *features).withColumn("row", F.monotonically_increasing_id()), "explained")
    mask_col = F.array(*[F.array(*[F.lit(int(v)) for v in z]) for z in masks])
    bg_col = F.array(*[F.array(*[F.lit(float(b[f])) for f in features]) for b in backgrounds])
    exploded = (numbered.select(id_col, "row", *features, F.posexplode(mask_col).alias("_k", "_z"))
                .select("*", F.explode(bg_col).alias("_b")))
    blended = exploded.select(id_col, "row", "_k", *[
        F.when(F.col("_z")[j] == 1, F.col(f).cast("double")).otherwise(F.col("_b")[j]).alias(f)
        for j, f in enumerate(features)])
    out = model.transform(blended)
    is_numeric = out.schema[output_col].dataType.typeName() in ("double", "float", "integer", "long")
    f_col = F.col(output_col).cast("double") if is_numeric else vector_to_array(output_col)[score_index]
    k = F.col("_k")
    sums = [F.sum(F.col("_f") * F.array(*[F.lit(float(v)) for v in w])[k]) for w in weights]
    share = 1.0 / len(backgrounds)
    solved = (out.select(id_col, "row", "_k", f_col.alias("_f")).groupBy("row", id_col)
              .agg(F.array(*sums).alias("phi"), F.sum(F.when(k == 0, F.col("_f") * share)).alias("f_x"),
                   F.sum(F.when(k == 1, F.col("_f") * share)).alias("f_baseline")))
    named = F.posexplode(F.array(*[F.lit(f) for f in features])).alias("_j", "feature")
    return (solved.select(id_col, "row", "phi", "f_x", "f_baseline", named)
            .select(id_col, "row", "feature", F.col("phi")[F.col("_j")].alias("shap_value"), "f_x", "f_baseline"))


def shap_global(local: DataFrame) -> DataFrame:
    """Global importance: mean absolute SHAP value per feature."""
    return local.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))
