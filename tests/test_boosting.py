"""Second-order boosting against a plain NumPy version, and what its parameters do."""

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from churnlab.operators import boosting as B
from churnlab.operators.prep import key_hash

COLS = ["a", "b", "c"]


def data(seed=0, n=900):
    rnd = np.random.default_rng(seed)
    a, b, c = rnd.normal(size=n), rnd.integers(0, 6, n).astype(float), rnd.normal(size=n)
    y = (rnd.random(n) < 1 / (1 + np.exp(-(1.5 * (a > 0.3) + 0.8 * (b == 2) - 1)))).astype(int)
    rows = []
    for i in range(n):
        x = [None if rnd.random() < 0.1 else float("nan") if rnd.random() < 0.05 else float(v) for v in (a[i], b[i], c[i])]
        rows.append((f"k{i}", *x, int(y[i]), "extra"))
    return rows


def plain(model, rows, u, p, turns):
    """Trees from straightforward loops: nested dicts with the split rule spelled out."""
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows], float)
    y = np.array([r[4] for r in rows], float)
    bins = np.stack([np.where(np.isnan(x[:, j]), 0, [1 + sum(e < v for e in model.edges[j]) for v in x[:, j]]) for j in range(3)], axis=1)
    margin, trees = np.zeros(len(y)), []

    def grow(at, g, h, node, level, out):
        total_g, total_h = sum(g[at]), sum(h[at])
        best = None
        if level < p["max_depth"]:
            for j in range(3):
                for cut in range(1, bins[:, j].max() + 2):
                    for left in (False, True):
                        go = [i for i in at if (bins[i, j] <= cut if bins[i, j] else left)]
                        gl, hl = sum(g[go]), sum(h[go])
                        if hl < p["min_child_weight"] or total_h - hl < p["min_child_weight"]:
                            continue
                        gain = gl**2 / (hl + 1) + (total_g - gl)**2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
                        if gain > 0 and gain >= p["gamma"] and (best is None or gain > best[0] + 1e-9):
                            best = (gain, j, cut, left, go)
        if best is None:
            out[node] = -p["eta"] * total_g / (total_h + 1)
            return
        out[node] = best[:4]
        inside = set(best[4])
        grow(best[4], g, h, 2 * node, level + 1, out)
        grow([i for i in at if i not in inside], g, h, 2 * node + 1, level + 1, out)

    for turn in range(turns):
        pr = 1 / (1 + np.exp(-margin))
        g, h = np.rint((pr - y) * 2**24) / 2**24, np.rint(pr * (1 - pr) * 2**24) / 2**24
        out = {}
        grow(np.flatnonzero(B.drawn(u, turn, p["subsample"])).tolist(), g, h, 1, 0, out)
        trees.append(out)
        for i in range(len(y)):
            n = 1
            while isinstance(out[n], tuple):
                _, j, cut, left = out[n]
                n = 2 * n + (not (bins[i, j] <= cut if bins[i, j] else left))
            margin[i] += out[n]
    return trees, margin


@pytest.fixture(scope="module")
def frame(spark):
    rows = data()
    df = spark.createDataFrame(rows, "msno string, a double, b double, c double, is_churn int, y string").repartition(5)
    u = {r.msno: r.u for r in df.select("msno", key_hash("msno", 42).alias("u")).collect()}
    return df, rows, np.array([u[r[0]] for r in rows])


@pytest.mark.parametrize("own", [{}, dict(gamma=0.0, min_child_weight=1.0), dict(gamma=15.0), dict(min_child_weight=60.0), dict(max_depth=2, subsample=1.0)])
def test_against_numpy(frame, own, monkeypatch):
    monkeypatch.setattr(B, "STAGED", 2)
    df, rows, u = frame
    p = {**B.PARAMS, "max_depth": 3, **own}
    model = B.train_boosted(df, COLS, max_bins=12, num_round=3, **{k: v for k, v in p.items() if k != "num_round"})
    want, margin = plain(model, rows, u, p, 3)
    for tree, plain_tree in zip(model.trees, want):
        for n, w in plain_tree.items():
            if isinstance(w, tuple):
                assert (tree.feature[n], tree.bin[n], tree.missing_left[n]) == w[1:] and tree.gain[n] == pytest.approx(w[0], abs=1e-6)
            else:
                assert tree.feature[n] == -1 and tree.value[n] == pytest.approx(w, abs=1e-9)
    got = {r.msno: r.score for r in B.score_boosted(model, df).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx((1 / (1 + np.exp(-margin))).tolist(), abs=1e-9)


def test_parameters_change_the_trees(frame):
    df = frame[0]
    size = lambda **own: sum(int((t.feature >= 0).sum()) for t in B.train_boosted(df, COLS, num_round=2, **own).trees)
    free = size(gamma=0.0, min_child_weight=0.0)
    assert free > size(gamma=4.0, min_child_weight=0.0) > size(gamma=40.0, min_child_weight=0.0)
    assert free > size(gamma=0.0, min_child_weight=30.0)


def test_any_partitioning(frame):
    df = frame[0]
    rows = [B.tree_rows(B.train_boosted(df.repartition(n), COLS, num_round=2)) for n in (1, 7)]
    assert rows[0] == rows[1] and rows[0]


def test_blocks_over_the_cores_and_passes_of_a_tree(spark, frame, monkeypatch):
    """One file of rows is dealt over several tasks; a tree takes a pass for each level of splits, none for the leaves."""
    calls, to_arrow = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda df: calls.append(df) or to_arrow(df))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        edges, rows = B.binned(frame[0].coalesce(1), COLS, max_bins=12)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows.inputFiles()) > 1
    run = B.carry_on(B.Run(B.Boosted(COLS, edges, 3), rows, B.settings(max_depth=3, gamma=0.0, min_child_weight=0.0)), 2)
    assert all((t.cover[8:] > 0).any() for t in run.model.trees) and len(calls) == 2 * 3
    assert B.tree_rows(run.model) == B.tree_rows(B.train_boosted(frame[0], COLS, max_bins=12, max_depth=3, gamma=0.0, min_child_weight=0.0, num_round=2))


def test_gbt_reads_few_files_by_all_cores(spark, tmp_path):
    """A frame of one file is dealt over the cores where it is large, and left alone where it is small."""
    from churnlab.operators import model

    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    parts = lambda df: df.rdd.getNumPartitions()
    assert parts(model.over_cores(rows, least=100)) == spark.sparkContext.defaultParallelism > parts(model.over_cores(rows)) == parts(rows) == 1
    assert sorted(r.id for r in model.over_cores(rows, least=100).collect()) == list(range(1000))


def test_edge_cases(spark, frame):
    df = frame[0]
    empty = B.train_boosted(df.limit(0), COLS, num_round=2)
    assert [r.score for r in B.score_boosted(empty, df.limit(3)).collect()] == [0.5] * 3
    constant = B.train_boosted(spark.createDataFrame([(f"k{i}", None, 1.0, i % 2) for i in range(50)], "msno string, a double, b double, is_churn int"),
                               ["a", "b"], num_round=2)
    assert all((t.feature == -1).all() for t in constant.trees)
    with pytest.raises(ValueError):
        B.train_boosted(df, COLS, depth=3)
