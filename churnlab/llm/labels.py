"""Labelled samples for the two classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm._trees import Trees, fit


def remainder(col: str, mod: int) -> Column:
    return F.crc32(F.col(col).cast("string")) % mod


def sample(rows: DataFrame, features: str, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of at most ``max_rows`` rows of (_id, label, features),
    those with the smallest hashed ids: the same rows however data are dealt."""
    got = rows.select("_id", "label", features).orderBy(F.xxhash64("_id"), "_id").limit(max_rows).toArrow()
    got = got.sort_by("_id").combine_chunks()
    y = np.asarray(got.column("label").cast(pa.float64()))
    col = got.column(features)
    flat = np.asarray(col.combine_chunks().flatten() if len(got) else [], np.float64)
    return flat.reshape(len(got), -1) if len(got) else np.zeros((0, 1)), y


def fit_sample(rows: DataFrame, features: str, max_rows: int, **options) -> Trees:
    return fit(*sample(rows, features, max_rows), **options)


def with_labels(frame: DataFrame, labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    """Rows of ``frame`` whose ``_doc`` has a label 0 or 1, as ``label``; a row for each label."""
    own = labels.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{label_col}`").cast("int").alias("label"))
    return frame.join(own.where(F.col("label").isin(0, 1)), "_doc")


def score_rows(trees: Trees, features: str):
    def run(batches):
        for batch in batches:
            col = batch.column(features)
            x = np.asarray(col.flatten(), np.float64).reshape(len(col), -1) if len(col) else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(trees.score(x) if len(x) else [], pa.float64())],
                                             ["_doc", "score"])
    return run


def scored(frame: DataFrame, trees: Trees, features: str, id_col: str, held_out: Column, threshold: float) -> DataFrame:
    """One row per row of ``frame``: the id, held_out, score, predicted."""
    kind = frame.schema["_doc"].dataType.simpleString()
    out = frame.select("_doc", features).mapInArrow(score_rows(trees, features), f"_doc {kind}, score double")
    return out.select(F.col("_doc").alias(id_col), F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
