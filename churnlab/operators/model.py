"""M1-M5: boosted-tree classifier on MLlib, persistence, scoring, loss curve, tuning.

The original trains a single-machine boosted-tree library; here the same interface
(depth 5, eta 0.2, subsample 0.7, 50 rounds) is an MLlib ``GBTClassifier`` inside a
``Pipeline`` so assembling, fitting and scoring run as Spark jobs, and the
fitted pipeline is saved/loaded as one unit.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.schemas import FEATURE_COLUMNS

FEATURE_INPUTS = FEATURE_COLUMNS[2:]
# The reference's boosted-tree settings.
DEFAULT_PARAMS = dict(maxDepth=5, stepSize=0.2, subsamplingRate=0.7, maxIter=50, minInstancesPerNode=6)


def gbt_pipeline(inputs: list[str] = FEATURE_INPUTS, label: str = "is_churn", seed: int = 42, **params) -> Pipeline:
    p = {**DEFAULT_PARAMS, **params}
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **p)
    return Pipeline(stages=[assembler, gbt])


def over_cores(rows: DataFrame, least: int = 50_000) -> DataFrame:
    """A written frame over all cores, where each gets at least ``least`` rows. A split is
    read by as many tasks as there are files that hold it, and a fit passes over these partitions
    for every level of every tree. Smaller frames stay as they are, and so do the rows that
    MLlib draws from them (it draws partition by partition)."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, len(rows.inputFiles()))
    return rows.repartition(n) if rows.count() >= n * least else rows


def train_gbt(train: DataFrame, inputs: list[str] = FEATURE_INPUTS, label: str = "is_churn", seed: int = 42,
              **params) -> PipelineModel:
    return gbt_pipeline(inputs, label, seed, **params).fit(over_cores(train).withColumn(label, F.col(label).cast("double")))


def feature_importances(model: PipelineModel, inputs: list[str] = FEATURE_INPUTS) -> list[tuple[str, float]]:
    imp = model.stages[-1].featureImportances.toArray()
    return [(f, float(v)) for f, v in zip(inputs, imp)]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Input columns kept; adds ``score`` (P(class 1)) and ``prediction``.
    With ``threshold`` the label is ``score >= threshold`` instead of argmax."""
    out = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    if threshold is not None:
        out = out.withColumn("prediction", F.when(F.col("score") >= threshold, 1.0).otherwise(0.0))
    return out.drop("features", "rawPrediction", "probability")


def loss_curve(model: PipelineModel, frames: dict[str, DataFrame], label: str = "is_churn") -> DataFrame:
    """(iteration, split, logloss) per boosting round; MLlib's log-loss is
    twice the binary log-loss, so it is halved."""
    assembler, gbt = model.stages[0], model.stages[-1]
    rows = []
    for name, df in frames.items():
        losses = gbt.evaluateEachIteration(assembler.transform(df.withColumn(label, F.col(label).cast("double"))))
        rows += [(i + 1, name, float(v) / 2.0) for i, v in enumerate(losses)]
    schema = T.StructType([T.StructField("iteration", T.IntegerType()), T.StructField("split", T.StringType()),
                           T.StructField("logloss", T.DoubleType())])
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(rows, schema)  # maxIter x splits values, bounded by parameters


def _logloss(model: PipelineModel, df: DataFrame, label: str) -> float:
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="logLoss", probabilityCol="probability")
    return ev.evaluate(model.transform(df.withColumn(label, F.col(label).cast("double"))))


def tune_gbt(train: DataFrame, valid: DataFrame, n_trials: int = 6, parallel: int = 3, min_iter: int = 1,
             max_iter: int = 10, eta: int = 3, seed: int = 42, label: str = "is_churn",
             inputs: list[str] = FEATURE_INPUTS) -> tuple[DataFrame, PipelineModel]:
    """Seeded random search over stepSize in (0,1) and maxDepth in [1,10] with
    successive halving on maxIter (from ``min_iter`` up to ``max_iter``, keeping
    the best 1/eta each rung). Each fit is an ordinary Spark job; up to
    ``parallel`` fits are submitted at once from a thread pool. The frames are
    read by every fit: pass written ones. Returns one row per (trial, rung) with
    the validation log-loss and the winning trial flagged, and the fitted winner."""
    rnd = random.Random(seed)
    trials = [dict(trial=i, stepSize=round(rnd.uniform(0.01, 0.99), 4), maxDepth=rnd.randint(1, 10))
              for i in range(n_trials)]
    rungs, it = [], min_iter
    while True:
        rungs.append(it)
        if it >= max_iter:
            break
        it = min(max_iter, it * eta)
    alive, rows = trials, []

    def run(t, iters):
        m = train_gbt(train, inputs, label, seed, maxIter=iters, stepSize=t["stepSize"], maxDepth=t["maxDepth"])
        return t, iters, _logloss(m, valid, label), m

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for r, iters in enumerate(rungs):
            results = list(pool.map(lambda t: run(t, iters), alive))
            rows += [(t["trial"], r, t["stepSize"], t["maxDepth"], iters, loss) for t, _, loss, _ in results]
            keep = max(1, math.ceil(len(alive) / eta))
            ranked = sorted(results, key=lambda x: (x[2], x[0]["trial"]))
            alive, winner = [t for t, *_ in ranked[:keep]], ranked[0][3]
    best = alive[0]["trial"]
    schema = T.StructType([T.StructField("trial", T.IntegerType()), T.StructField("rung", T.IntegerType()),
                           T.StructField("step_size", T.DoubleType()), T.StructField("max_depth", T.IntegerType()),
                           T.StructField("max_iter", T.IntegerType()), T.StructField("val_logloss", T.DoubleType())])
    return train.sparkSession.createDataFrame(rows, schema).withColumn("best", F.col("trial") == best), winner


def scoring_unit(imputer_model, indexer_model, trained: PipelineModel, impute_cols: list[str],
                 categorical: list[str], passthrough: list[str], inputs: list[str] = FEATURE_INPUTS) -> PipelineModel:
    """One persistable unit from already fitted parts: cast/fill -> mean
    imputation -> string indexing -> assembling -> the trained classifier.

    It scores raw (un-imputed, un-indexed) rows carrying ``passthrough`` plus the
    imputed and categorical columns; the vector layout equals the one the
    classifier was trained on (indexed columns in the same slots). The fitted
    imputer and indexer are used as fitted (their column names unchanged)."""
    from pyspark.ml.feature import SQLTransformer

    cols = ([f"`{c}`" for c in passthrough if c not in impute_cols and c not in categorical]
            + [f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in impute_cols]
            + [f"coalesce(CAST(`{c}` AS STRING), 'other') AS `{c}`" for c in categorical])
    prep_sql = SQLTransformer(statement=f"SELECT {', '.join(cols)} FROM __THIS__")
    outs = dict(zip(indexer_model.getInputCols(), indexer_model.getOutputCols()))
    assembler = VectorAssembler(inputCols=[outs.get(c, c) for c in inputs], outputCol="features",
                                handleInvalid="keep")
    return PipelineModel(stages=[prep_sql, imputer_model, indexer_model, assembler, trained.stages[-1]])


def score_raw(unit: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    out = unit.transform(df).withColumn("score", vector_to_array("probability")[1])
    return out.select(*keep, "score", "prediction")
