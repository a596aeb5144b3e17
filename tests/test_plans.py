"""Plan-shape checks: fused aggregates, pushdown, bounded broadcasts."""

from churnlab.operators.transactions import txn_features
from churnlab.plans import features
from churnlab.sources import adapters

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_txn_features_one_scan_one_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(txn_features(adapters.transactions(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("FileScan parquet") == 1
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(adapters.members(spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def test_rare_bucketing_is_a_projection(spark):
    plan = _plan(features.clean(spark, SF_SMALL))
    # reads the checkpointed per-user frame; bucketing adds no join or exchange
    assert "Exchange" not in plan and "Join" not in plan


def test_curves_never_window_all_rows_in_one_partition(spark):
    from churnlab.operators import evaluation as ev
    import re
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(ev.roc_curve(adapters.predictions(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the per-score window is partitioned by slice; only the bounded offsets table
    # (one row per slice) uses an unpartitioned window
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)
    assert any("_slice" in w for w in windows)


def test_shap_solver_is_one_partial_aggregate(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F
    from churnlab.operators import explain

    df = spark.range(50).select(F.col("id").cast("string").alias("msno"), (F.col("id") % 7).cast("double").alias("a"),
                                (F.col("id") % 2).cast("int").alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features"),
                             LogisticRegression(labelCol="label")]).fit(df)
    plan = _plan(explain.shap_local(model, df, {"a": 0.0}, ["a"], n_samples=5))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan  # a row's sums, not its samples, are shuffled
    assert "InPandas" not in plan and "EvalPython" not in plan


def test_one_hot_levels_reject_high_cardinality(spark):
    import pytest
    from churnlab.operators import prep
    df = spark.range(50).selectExpr("cast(id as string) as c")
    with pytest.raises(ValueError):
        prep.category_levels(df, ["c"], max_levels=10)


def test_joined_scans_orders_once_and_equals_generic_join(spark):
    from churnlab.operators.assemble import features_joined
    from churnlab.operators.logs import log_means
    from churnlab.operators.members import members_filled
    fused = features.joined(spark, SF_SMALL)
    plan = _plan(fused)
    assert plan.count("orders.parquet") == 1
    generic = features_joined(adapters.train(spark, SF_SMALL), txn_features(adapters.transactions(spark, SF_SMALL)),
                              members_filled(adapters.members(spark, SF_SMALL)),
                              log_means(adapters.user_logs(spark, SF_SMALL)))
    cols = sorted(fused.columns)
    assert cols == sorted(generic.columns)
    assert fused.select(cols).exceptAll(generic.select(cols)).count() == 0
    assert generic.select(cols).exceptAll(fused.select(cols)).count() == 0


def test_feature_dataset_splits_a_hot_key(spark):
    """Both join sides have a shuffle of their own, so a hot key's partition is split."""
    from churnlab.sources import feature_table as ft

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        h = spark.sql("""SELECT if(id % 3 = 0, 'hot', cast(id % 997 AS string)) AS msno,
                         TIMESTAMP_NTZ '2000-01-01 00:00:00' + make_dt_interval(0, 0, cast(id AS int)) AS event_time,
                         id AS write_seq, id AS x, id % 5000 = 7 AS deleted FROM range(60000)""")
        got = ft.feature_dataset(h, ["x"])
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "skew=true" in plan
    last: dict = {}
    for i in range(60000):
        if i % 5000 == 7:
            last["hot" if i % 3 == 0 else str(i % 997)] = i
    want = sorted(i for i in range(60000) if i % 5000 != 7 and i > last.get("hot" if i % 3 == 0 else str(i % 997), -1))
    assert sorted(r.x for r in rows) == want
