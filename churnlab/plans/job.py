"""The feature job end to end: read the tables, build the modelling frame and
write the three splits (Parquet by default; headerless CSV as an export).

    python -m churnlab.plans.job --sf-dir /path/to/tables --out /shared/features [--csv] [--model]

Each split is written by the tasks that hold it (no single-task funnel);
``maxRecordsPerFile`` bounds file sizes.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.operators import evaluation as ev, model as mdl
from churnlab.plans import features
from churnlab.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS, IMPUTE_COLUMNS
from churnlab.session import checkpoint_dir, cut_lineage, drop_scratch


SPLITS = ("train", "test", "validation")


def split_frames(final: DataFrame) -> dict[str, DataFrame]:
    return {s: final.where(F.col("split") == s) for s in SPLITS}


def write_splits(final: DataFrame, out_dir: str, fmt: str = "parquet", max_records_per_file: int = 5_000_000) -> dict:
    """Write the frame once, as ``out_dir/split=<name>``; returns the splits' paths."""
    w = (final.select("split", *FEATURE_COLUMNS).write.mode("overwrite").partitionBy("split")
         .option("maxRecordsPerFile", max_records_per_file))
    if fmt == "csv":
        w.option("header", False).csv(out_dir)
    else:
        w.parquet(out_dir)
    return {name: os.path.join(out_dir, f"split={name}") for name in SPLITS}


def run_feature_job(spark: SparkSession, sf_dir: str, out_dir: str, fmt: str = "parquet") -> dict:
    return write_splits(features.final(spark, sf_dir), out_dir, fmt)


def run_model_job(spark: SparkSession, sf_dir: str, out_dir: str, **params) -> dict:
    """Features, fit, one scoring unit saved and loaded, raw held-out rows scored
    with it and written, their report written as JSON. Returns the paths
    ``unit``, ``predictions`` (msno, split, is_churn, score, prediction) and
    ``report`` (of the test rows)."""
    parts = features.final_parts(spark, sf_dir)
    frames = split_frames(cut_lineage(parts["final"], "final"))
    raw = parts["split"].where(F.col("split") != "train")
    unit = mdl.scoring_unit(parts["imputer"], parts["indexer"], mdl.train_gbt(frames["train"], **params), IMPUTE_COLUMNS,
                            CATEGORICAL_COLUMNS, raw.columns)
    paths = {k: os.path.join(out_dir, k) for k in ("unit", "predictions", "report")}
    mdl.save_model(unit, paths["unit"])
    scored = mdl.score_raw(mdl.load_model(paths["unit"]), raw, ["msno", "split", "is_churn"])
    scored.write.mode("overwrite").parquet(paths["predictions"])
    test = spark.read.parquet(paths["predictions"]).where(F.col("split") == "test")
    ev.write_report(ev.eval_report(test), paths["report"])
    return paths


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="churn feature job")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--csv", action="store_true", help="headerless CSV instead of Parquet")
    ap.add_argument("--model", action="store_true", help="also fit, score and report, under <out>/model")
    a = ap.parse_args(argv)
    spark = (SparkSession.builder.appName("churnlab-feature-job")
             .config("spark.ui.enabled", "false").getOrCreate())
    checkpoint_dir(spark)
    print(run_feature_job(spark, a.sf_dir, a.out, "csv" if a.csv else "parquet"))
    if a.model:
        print(run_model_job(spark, a.sf_dir, os.path.join(a.out, "model")))
    drop_scratch(spark)


if __name__ == "__main__":
    main()
