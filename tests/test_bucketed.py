"""The bucketed feature table: rules, plans without an exchange of the history, a hot key."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from churnlab.sources import feature_table as ft


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """A third of the rows under one key, a record written twice, missing flags and sequences, a NULL key."""
    t = lambda d: dt.datetime(2020, 1, 1) + dt.timedelta(days=d)
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", t(i % 90), i, float(i), i % 17 == 0) for i in range(900)]
    rows += [("k1", t(200), 1, -1.0, None), ("k1", t(200), None, -2.0, True), ("only", t(1), None, 5.0, None), (None, t(1), 3, 6.0, False)]
    df = spark.createDataFrame(rows, "msno string, event_time timestamp_ntz, write_seq long, x double, deleted boolean")
    table, path = f"buckets_{uuid.uuid4().hex}", str(tmp_path_factory.mktemp("buckets") / "h")
    ft.append_bucketed(df.where("x % 2 = 0"), table, path, 4)
    ft.append_bucketed(df.where("x % 2 <> 0"), table, path, 4)
    yield df, spark.table(table)
    spark.sql(f"DROP TABLE {table}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_same_as_the_plain_table(history):
    df, table = history
    rows = lambda x: sorted(map(tuple, x.collect()), key=str)
    assert table.count() == df.count()
    assert rows(ft.bucketed_dataset(table, ["x"])) == rows(ft.feature_dataset(df, ["x"])) != []
    for at in (dt.datetime(2019, 1, 1), dt.datetime(2020, 2, 10), dt.datetime(2021, 1, 1)):
        assert rows(ft.bucketed_dataset_asof(table, at, ["x"])) == rows(ft.feature_dataset_asof(df, at, ["x"]))


def test_no_exchange_of_the_history(spark, history):
    table = history[1]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dataset, asof = plan_of(ft.bucketed_dataset(table, ["x"])), plan_of(ft.bucketed_dataset_asof(table, dt.datetime(2020, 2, 10), ["x"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The only exchange of the dataset stands over the deletion times, that of the as-of dataset over one row per key and slot.
    below = dataset[dataset.index("Exchange"):]
    assert dataset.count("Exchange") == 1 and "_deleted_at" in below and "event_month" not in below
    assert asof.count("Exchange") == 1 and len(re.findall("Aggregate", asof[asof.index("Exchange"):])) == 3
    assert re.search(r"PartitionFilters: \[[^\]]*event_month", asof) and "Bucketed: true" in asof


def test_deletion_times_are_not_broadcast(spark, history):
    """However small Spark takes them to be, before the plan runs and while it does."""
    out = ft.bucketed_dataset(history[1], ["x"])
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and "Broadcast" not in plan_of(out)
    assert out.count() and "Broadcast" not in plan_of(out) and "SortMergeJoin" in plan_of(out)


def test_hot_key_lies_in_many_buckets(history):
    hot = history[1].where("msno = 'hot'").select(F.input_file_name().alias("f")).distinct().collect()
    assert len({re.search(r"_(\d{5})\.c", r.f)[1] for r in hot}) == 4


def test_rare_values_with_a_known_total(spark):
    """The number of rows, counted or given, gives the same shares; an empty frame has none."""
    from churnlab.operators import assemble

    df = spark.createDataFrame([(str(i % 7) if i % 5 else None, i % 3) for i in range(100)], "a string, b int")
    got = [sorted(map(tuple, assemble.category_counts(df, ["a", "b"], total=n).collect()), key=str) for n in (None, 100)]
    assert got[0] == got[1] and len(got[0]) == 11
    kept = assemble.frequent_values(df, ["a", "b"], 0.12)
    assert kept == assemble.frequent_values(df, ["a", "b"], 0.12, total=100) and kept["b"]
    assert assemble.rare_bucketed(df.limit(0), ["a"], 0.5).count() == 0
