"""Exact-size splits, dictionaries, nearest rows, merged sketches, drift: against brute force."""

import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.functions.selection import kth_smallest, quantile_values
from churnlab.operators import bias, drift, nearest, prep, quality, sketches
from churnlab.operators.assemble import unique_by
from churnlab.sources import feature_table


# ------------------------------------------------------------ selection, splits
def test_kth_smallest(spark):
    rnd = random.Random(0)
    values = [rnd.randrange(1 << 60) for _ in range(500)] + [7] * 40 + [0, (1 << 60) - 1]
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(4)
    ranks = [1, 2, 20, 41, 42, 300, len(values)]
    assert kth_smallest(df, F.col("x"), ranks) == [sorted(values)[r - 1] for r in ranks]


@pytest.mark.parametrize("limit", [10_000, 50, 1])
def test_quantile_values(spark, limit):
    """Small limits and coarse sketches force many rounds; one column has a hot value, one two values, one a single row."""
    rnd = random.Random(2)
    data = {"wide": [rnd.gauss(0, 1e6) for _ in range(3000)], "hot": [5.0] * 1500 + [rnd.random() * 10 for _ in range(1500)],
            "two": [1.0, 2.0] * 400, "one": [-3.5], "edges": [float("inf"), float("-inf"), 0.0, -0.0, 5e-324, 1.0, 1.0],
            "whole": [float(rnd.randrange(40)) for _ in range(999)]}
    rows = [(c, v) for c, values in data.items() for v in values] + [("none", None), ("one", None)]
    pairs = spark.createDataFrame(rows, "column string, v double").repartition(5).cache()
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantile_values(pairs, probs, limit=limit, accuracy=40, grid=10)
    pairs.unpersist()
    assert got.keys() == data.keys()
    for c, values in data.items():
        assert got[c][0] == len(values)
        values = sorted(values)
        for p, q in zip(probs, got[c][1]):
            h = (len(values) - 1) * p
            a, b = values[math.floor(h)], values[math.ceil(h)]
            assert q == (a + (b - a) * (h + 1 - math.floor(h + 1)) if a != b else a), (c, p)


def test_quantiles_agree(spark):
    """Ranges and the table of distinct values give the same; an empty table gives no rows."""
    df = spark.range(2000).select((F.col("id") * 7919 % 1013).cast("double").alias("a"), F.when(F.col("id") % 3 > 0, F.lit(1)).alias("b"),
                                  F.lit(None).cast("int").alias("c"))
    cols, probs = ["a", "b", "c"], [0.1, 0.5, 0.99]
    sets = [{tuple(r) for r in f(df, cols, probs).collect()} for f in (prep.exact_quantiles, prep.quantile_grid)]
    assert sets[0] == sets[1] and {r[0] for r in sets[0]} == {"a", "b"}
    assert prep.exact_quantiles(df.limit(0), cols, probs).count() == 0
    assert prep.exact_medians(df, cols) == {"a": statistics.median(float(i * 7919 % 1013) for i in range(2000)), "b": 1.0, "c": None}


@pytest.mark.parametrize("n", [0, 1, 2, 97, 1000])
def test_split_exact(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("msno"))
    stages = [(0.33, "test", 42), (0.125, "validation", 43)]
    got = [{r.msno: r.split for r in prep.split_exact(df.repartition(k), stages, "train").collect()} for k in (1, 5)]
    count = Counter(got[0].values())
    test = math.ceil(0.33 * n)
    assert got[0] == got[1] and len(got[0]) == n
    assert (count["test"], count["validation"]) == (test, math.ceil(0.125 * (n - test)))


# ---------------------------------------------------------------- dictionaries
def test_dictionary_as_string_indexer(spark):
    rnd = random.Random(1)
    rows = [(str(rnd.randrange(30)) if rnd.random() < 0.9 else None, rnd.choice(["x", "y", "Ä", ""])) for _ in range(800)]
    train = spark.createDataFrame(rows, "a string, b string").repartition(6)
    other = spark.createDataFrame([("3", "x"), ("new", None), (None, "zz")], "a string, b string")
    indexer, own = prep.fit_string_indexer(train, ["a", "b"]), prep.fit_dictionary(train, ["a", "b"])
    for df in (train, other):
        want = sorted(map(tuple, prep.string_index(df, indexer, ["a", "b"]).collect()))
        for small in (100_000, 0):  # looked up in a broadcast, or by a join
            assert sorted(map(tuple, prep.dictionary_index(df, own, ["a", "b"], small).collect())) == want


def test_dictionary_of_many_levels(spark):
    """A million levels; a third of the rows hold one of them. Beyond ``small`` nothing asks for a broadcast."""
    df = spark.range(1_500_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"))
    own = prep.fit_dictionary(df, ["a"])
    out = prep.dictionary_index(df, own, ["a"])
    top = own.orderBy("index").limit(3).collect()
    assert own.count() == 1_000_001 and [(r.level, r["index"], r.n) for r in top] == [("hot", 0, 500_000), ("1", 1, 1), ("10", 2, 1)]
    got = out.agg(F.count_if(F.col("a") == 0).alias("hot"), F.count_distinct("a").alias("d"), F.max("a").alias("top")).first()
    assert tuple(got) == (500_000, 1_000_001, 1_000_000)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [prep.dictionary_index(df, own, ["a"], small)._jdf.queryExecution().sparkPlan().toString() for small in (100_000, 2_000_000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ["BroadcastHashJoin" in p for p in plans] == [False, True] and "SortMergeJoin" in plans[0]


# --------------------------------------------------------------- nearest rows
def points(seed, n, hot=0.4):
    """Clusters, one of them hot and full of copies, and outliers."""
    rnd = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        u = rnd.random()
        out.append([5, 5, 5] if u < hot / 2 else (rnd.integers(0, 12, 3) if u < hot else rnd.integers(-3000, 3000, 3) if u < 0.95 else rnd.integers(-10**6, 10**6, 3)))
    return [[int(v) for v in p] for p in out]


@pytest.mark.parametrize("pivots,block", [(8, 15), (64, 2048), (1, 40)])
def test_nearest(spark, pivots, block):
    asked, held = points(1, 400), points(2, 900)
    keys = [f"k{(i * 37) % 900:03d}" for i in range(900)]
    q = spark.createDataFrame([(p,) for p in asked], "v array<long>").repartition(5)
    t = spark.createDataFrame([(p, k, float(i)) for i, (p, k) in enumerate(zip(held, keys))], "v array<long>, key string, value double").repartition(5)
    got = {tuple(r.v): (r.d2, r.key, r.value) for r in nearest.nearest_points(q, t, pivots, block).collect()}
    assert len(got) == len(set(map(tuple, asked)))
    for p in set(map(tuple, asked)):
        want = min((sum((a - b) ** 2 for a, b in zip(p, x)), k, float(i)) for i, (x, k) in enumerate(zip(held, keys)))
        assert got[p] == want


def test_nearest_edges(spark):
    q = spark.createDataFrame([([1, 2],)], "v array<long>")
    t = spark.createDataFrame([([4, 6], "b", 1.0), ([4, 6], "a", 0.0)], "v array<long>, key string, value double")
    assert [tuple(r) for r in nearest.nearest_points(q, t).collect()] == [([1, 2], 25, "a", 0.0)]
    assert nearest.nearest_points(q, t.limit(0)).count() == 0 and nearest.nearest_points(q.limit(0), t).count() == 0


def test_flip_test(spark):
    rows = [("a1", 0.0, None, "male", 1.0), ("a2", 10.0, 1.0, "male", 0.0), ("a3", 20.0, float("nan"), None, 1.0), ("d1", 0.5, 0.9, "female", 0.0),
            ("d2", 10.2, 1.1, "female", 1.0), ("d3", 19.0, 1.0, "female", 1.0), ("d4", 21.0, 1.0, "female", 0.0)]
    df = spark.createDataFrame(rows, "msno string, x double, y double, gender string, prediction double")
    pairs = {r.msno: r.near for r in bias.nearest_pairs(df, ["x", "y"]).collect()}
    assert pairs == {"d1": "a1", "d2": "a2", "d3": "a3", "d4": "a3"}
    assert tuple(bias.flip_test_nearest(df, ["x", "y"]).first()) == (4, 2, 1, 0.25)
    alone = bias.flip_test_nearest(df.where("gender = 'female'"), ["x", "y"]).first()
    assert (alone.n_d, alone.n_up, alone.ft) == (4, 0, 0.0)


def test_nearest_plan_has_no_pairs(spark):
    """No cartesian product or nested loop meets the two sides."""
    q = spark.createDataFrame([(p,) for p in points(1, 50)], "v array<long>")
    t = spark.createDataFrame([(p, str(i), 0.0) for i, p in enumerate(points(2, 50))], "v array<long>, key string, value double")
    plan = nearest.nearest_points(q, t)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


# --------------------------------------------------------------------- missing values
def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert prep.exact_medians(df, ["x"]) == {"x": 2.0}
    assert [r.x for r in prep.impute_with(df, {"x": 2.0}).collect()] == [1.0, 2.0, 3.0, 2.0, 2.0]
    stats = prep.fit_outlier_means(df, ["x"])
    assert stats["x"] == {"mean": 2.0, "std": 1.0, "inlier_mean": 2.0, "outliers": 0}
    assert [r.x for r in prep.outliers_to_mean(df, stats).collect()] == [1.0, 2.0, 3.0, None, None]
    scaled = prep.standardize(df, prep.fit_standardizer(df, ["x"])).collect()
    assert [None if r.x is None else round(r.x, 4) for r in scaled] == [-1.2247, 0.0, 1.2247, None, None]


def test_feature_table_without_flag_or_sequence(spark):
    rows = [("a", "2020-01-01", 1, None, 1), ("a", "2020-01-02", None, None, 2), ("a", "2020-01-02", 0, False, 3), ("b", "2020-01-01", None, None, 4),
            ("c", "2020-01-01", None, False, 5), ("c", "2020-01-03", 2, True, 6), ("c", "2020-01-04", None, None, 7)]
    h = spark.createDataFrame(rows, "msno string, t string, write_seq int, deleted boolean, x int").withColumn("event_time", F.col("t").cast("timestamp_ntz"))
    got = {(r.msno, str(r.event_time)[:10], r.x) for r in feature_table.feature_dataset(h, ["x"]).collect()}
    assert got == {("a", "2020-01-01", 1), ("a", "2020-01-02", 3), ("b", "2020-01-01", 4), ("c", "2020-01-04", 7)}
    import datetime as dt
    latest = {(r.msno, r.x) for r in feature_table.feature_dataset_asof(h, dt.datetime(2020, 1, 2), ["x"]).collect()}
    assert latest == {("a", 3), ("b", 4), ("c", 5)}


def test_unique_by(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", None, None), (None, 3, "z")], "msno string, x int, y string")
    assert sorted(map(tuple, unique_by(df, "msno").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    with pytest.raises(Exception, match="not unique"):
        spark.createDataFrame([("b",)], "msno string").join(unique_by(df.unionByName(df), "msno"), "msno", "left").select("msno").collect()


# --------------------------------------------------------------- sketches, drift
COLS = ["x", "w", "s"]


def part(spark, day, n, seed):
    rnd = random.Random(seed)
    rows = [(day, rnd.choice([None, float("nan"), rnd.gauss(3, 2)]) if rnd.random() < 0.2 else rnd.gauss(0, 1), rnd.randrange(1 << 40), rnd.choice("abc")) for _ in range(n)]
    return spark.createDataFrame(rows, "day int, x double, w long, s string").repartition(3)


def test_merged_profile(spark, tmp_path):
    path, days = f"file://{tmp_path}/k", [part(spark, d, 3000, d) for d in (1, 2, 3)]
    first = days[0].unionByName(days[1])
    assert sketches.add_parts(first, path, "day", COLS) == [1, 2] and sketches.add_parts(first, path, "day", COLS) == []
    whole = first.unionByName(days[2])
    assert sketches.add_parts(whole, path, "day", COLS) == [3]
    got = {r.column: r for r in sketches.merged_profile(sketches.stored_sketches(spark, path)).collect()}
    rows = whole.collect()
    x = np.array([r.x for r in rows if r.x is not None and r.x == r.x])
    w = [r.w for r in rows]
    assert (got["x"].n, got["x"].n_missing) == (9000, 9000 - len(x)) and (got["x"].min, got["x"].max) == (x.min(), x.max())
    assert (got["x"].mean, got["x"].std) == pytest.approx((x.mean(), x.std(ddof=1))) and got["w"].total == float(sum(w))
    assert (got["s"].n_distinct, got["s"].p50, got["s"].mean) == (3, None, None) and abs(got["w"].n_distinct - len(set(w))) < 0.08 * len(set(w))
    assert all(r.rank_error <= sketches.RANK_ERROR for r in sketches.rank_errors(whole, sketches.merged_profile(sketches.stored_sketches(spark, path)), ["x", "w"]).collect())


def test_a_new_part_reads_only_itself(spark, tmp_path):
    """The rows of stored parts are not in the second run: they would fail it."""
    path = f"file://{tmp_path}/k"
    sketches.add_parts(part(spark, 1, 100, 1), path, "day", COLS)
    bad = part(spark, 1, 100, 1).withColumn("w", F.raise_error(F.lit("read again")).cast("long"))
    assert sketches.add_parts(bad.unionByName(part(spark, 2, 100, 2)), path, "day", COLS) == [2]


def test_distribution_drift(spark):
    rnd = np.random.default_rng(0)
    make = lambda x, s: spark.createDataFrame([(float(a) if a == a else None, b) for a, b in zip(x, s)], "x double, s string")
    base = make(rnd.normal(0, 1, 2000), rnd.choice(list("aab"), 2000))
    same = make(rnd.normal(0, 1, 1500), rnd.choice(list("aab"), 1500))
    wide = make(rnd.normal(0, 3, 1500), rnd.choice(list("abc"), 1500))  # the mean stays, the spread does not
    got = {n: {r.column: r for r in drift.distribution_drift(base, d, ["x"], ["s"]).collect()} for n, d in (("same", same), ("wide", wide))}
    assert not got["same"]["x"].drifted and not got["same"]["s"].drifted and got["wide"]["x"].drifted and got["wide"]["s"].drifted
    a, b = (np.sort([r.x for r in d.collect()]) for d in (base, wide))
    at = np.concatenate([a, b])
    want = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
    assert got["wide"]["x"].distance == pytest.approx(want)
    assert drift.distribution_drift(base, base.limit(0), ["x"], ["s"]).count() == 0


def test_baseline_of_one_row_reports_a_shift(spark):
    one, many = (spark.createDataFrame([(v,) for v in vs], "x double") for vs in ([3.0], [300.0, 400.0]))
    got = [(r.check, r.baseline_value, r.observed_value) for r in quality.drift_violations(quality.profile_table(one), quality.profile_table(many)).collect()]
    assert got == [("mean_shift", 3.0, 350.0)]
    assert quality.drift_violations(quality.profile_table(one), quality.profile_table(one)).count() == 0


def test_profile_of_large_whole_numbers(spark):
    df = spark.createDataFrame([(2**53,), (1,), (None,)], "x long")
    for exact in (False, True):
        r = quality.profile_table(df, exact_distinct=exact).first()
        assert (r.total_text, r.min_text, r.max_text) == (str(2**53 + 1), "1", str(2**53))
