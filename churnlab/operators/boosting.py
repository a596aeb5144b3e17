"""M1: second-order boosted trees with a minimum split loss and hessian-weighted leaves.

MLlib's boosted trees have no counterpart to ``gamma`` and count rows where
``min_child_weight`` sums hessians. Here a tree grows level by level from
histograms: a task adds up gradients and hessians of its rows by (node, feature,
bin), Spark adds the tasks', and only these sums, at most ``2^depth * features *
bins`` rows, reach the driver, which picks the splits. Of two siblings the lighter
one alone is added up, the other is what is left of its parent; the sums of the last
level's leaves follow from the splits above them. With logistic loss a row has
gradient p - y and hessian p (1 - p); a split's loss reduction is
``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)`` and must be positive and at least
``gamma``; both sides need a hessian of ``min_child_weight``; a leaf is
``-eta G / (H+l)``. Missing values (NULL, NaN) go to the side that is better.
Sums are of whole numbers (units of 2^-24), so trees are the same however rows are
dealt. Rows are drawn for a round by a hash of key and round.

Rows are binned once and written as blocks (the rows of an Arrow batch, column by column,
as bytes), dealt over all cores; the margin of finished trees is written anew
every ``STAGED`` rounds, and later trees are added on the fly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.operators.prep import quantile_grid, key_hash, present
from churnlab.session import cut_lineage, ship_package

STAGED = 10
UNIT = float(1 << 24)
# The reference's boosted-tree settings.
PARAMS = dict(max_depth=5, eta=0.2, gamma=4.0, min_child_weight=6.0, subsample=0.7, num_round=50)


@dataclass
class Tree:
    """Nodes by their number: the root is 1, the children of n are 2n and 2n + 1."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 << depth
        return Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row of bins [feature, row] has come to."""
        n, split, number = bins.shape[1], self.feature >= 0, np.arange(len(self.feature))
        first, left = np.where(split, self.feature, 0) * n, np.where(split, 2 * number, number)
        # The missing bin 0 goes left as it is; less one, in 8 bits, it is 255 and goes right. A leaf lets no bin pass.
        less = (split & ~self.missing_left).astype(np.uint8)
        last = np.where(split, self.bin - less, 255).astype(np.uint8)
        flat, at, node = bins.reshape(-1), np.arange(n), np.ones(n, np.int64)
        for _ in range(depth):
            node = left[node] + (flat[first[node] + at] - less[node] > last[node])
        return node


@dataclass
class Boosted:
    """A fitted model: columns, bin edges, trees."""

    cols: list[str]
    edges: list[np.ndarray]
    depth: int
    trees: list[Tree] = field(default_factory=list)

    def bins(self, batch: pa.RecordBatch) -> np.ndarray:
        """Bin of each column and row: 0 where missing, else 1 + the number of edges below the value."""
        out = np.zeros((len(self.cols), batch.num_rows), np.uint8)
        for j, c in enumerate(self.cols):
            x = np.asarray(batch.column(f"_x{j}"), float)
            out[j] = np.where(np.isnan(x), 0, 1 + np.searchsorted(self.edges[j], x, "left"))
        return out

    def margin(self, bins: np.ndarray, first: int = 0) -> np.ndarray:
        out = np.zeros(bins.shape[1])
        for t in self.trees[first:]:
            out += t.value[t.leaves(bins, self.depth)]
        return out


def fit_edges(train: DataFrame, cols: list[str], max_bins: int) -> list[np.ndarray]:
    """Bin edges: distinct exact quantiles, at most ``max_bins - 1`` a column."""
    probs = [k / max_bins for k in range(1, max_bins)]
    got = {r["column"]: sorted({v for k, v in r.asDict().items() if k != "column" and v is not None})
           for r in quantile_grid(train, cols, probs).collect()}
    return [np.array(got.get(c, []), float) for c in cols]


def _inputs(cols: list[str]) -> list:
    return [present(c).alias(f"_x{j}") for j, c in enumerate(cols)]


def _binned(model: Boosted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = (np.asarray(batch.column("u"), np.int64), np.asarray(batch.column("y")).astype(np.uint8), model.bins(batch), np.zeros(batch.num_rows))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], ["u", "y", "bins", "margin"])
    return run


def _blocks(batch: pa.RecordBatch, n: int) -> Iterator[dict[str, np.ndarray]]:
    """The blocks of a batch; ``bins`` as [feature, row]."""
    kinds = {"u": np.int64, "y": np.uint8, "bins": np.uint8, "margin": float}
    for k in range(batch.num_rows):
        one = {c: np.frombuffer(batch.column(c)[k].as_buffer(), kinds[c]) for c in batch.schema.names}
        yield one | {"bins": one["bins"].reshape(n, -1)}


def drawn(u: np.ndarray, turn: int, share: float) -> np.ndarray:
    """Which rows take part in a round; ``u`` is a 60-bit hash of the key."""
    x = (u.astype(np.uint64) + np.full(1, turn, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) * 2.0**-53 < share


def gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians in units of 2^-24."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - y) * UNIT), np.rint(p * (1 - p) * UNIT)


def _histograms(model: Boosted, staged: int, tree: Tree, level: int, asked: list[int], turn: int, share: float, width: int):
    """(slot, g, h): sums by (place of the node in ``asked``, feature, bin)."""
    n, size = len(model.cols), len(asked) * width
    place = np.full(2 << level, -1)
    place[asked] = np.arange(len(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, n, size), np.int64)
        for batch in batches:
            for block in _blocks(batch, n):
                take = np.flatnonzero(drawn(block["u"], turn, share))
                bins = block["bins"][:, take]
                at = place[tree.leaves(bins, level)]
                on = np.flatnonzero(at >= 0)
                bins, at, take = bins[:, on], at[on] * width, take[on]
                of_rows = gradients(block["margin"][take] + model.margin(bins, staged), block["y"][take])
                for j in range(n):
                    slot = at + bins[j]
                    for total, x in zip(sums[:, j], of_rows):
                        total += np.bincount(slot, x, size).astype(np.int64)
        g, h = (x.reshape(n, -1, width).transpose(1, 0, 2).ravel() for x in sums)
        used = np.flatnonzero((g != 0) | (h != 0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(g[used]), pa.array(h[used])], ["slot", "g", "h"])
    return run


def best_split(g: np.ndarray, h: np.ndarray, gamma: float, min_child_weight: float, reg_lambda: float) -> tuple | None:
    """(gain, feature, bin, missing left) of a node's histograms [feature, bin], in
    plain units; bin 0 holds the missing values. Ties: the first feature, then bin,
    then missing values to the right."""
    total_g, total_h = g[0].sum(), h[0].sum()
    score = lambda a, b: a * a / (b + reg_lambda)
    best = None
    for left in (False, True):
        gl, hl = np.cumsum(g[:, 1:], axis=1), np.cumsum(h[:, 1:], axis=1)
        if left:
            gl, hl = gl + g[:, :1], hl + h[:, :1]
        gr, hr = total_g - gl, total_h - hl
        gain = np.where((hl >= min_child_weight) & (hr >= min_child_weight), score(gl, hl) + score(gr, hr) - score(total_g, total_h), -np.inf)
        f, b = np.unravel_index(gain.argmax(), gain.shape)
        found = (float(gain[f, b]), int(f), int(b) + 1, left)
        if best is None or (-found[0], *found[1:]) < (-best[0], *best[1:]):
            best = found
    return best if best[0] > 0 and best[0] >= gamma else None


def _summed(model: Boosted, rows: DataFrame, staged: int, tree: Tree, level: int, asked: list[int], turn: int, share: float) -> dict[int, np.ndarray]:
    """The histograms [g or h, feature, bin] of the nodes ``asked`` of a level, whole numbers."""
    n, width = len(model.cols), max(len(e) for e in model.edges) + 2
    sums = (rows.mapInArrow(_histograms(model, staged, tree, level, asked, turn, share, width), "slot long, g long, h long")
            .groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow())
    out = np.zeros((2, len(asked) * n * width), np.int64)
    out[:, np.asarray(sums.column("slot"))] = np.asarray(sums.column("g")), np.asarray(sums.column("h"))
    return dict(zip(asked, out.reshape(2, -1, n, width).swapaxes(0, 1)))


def _grow(model: Boosted, rows: DataFrame, staged: int, turn: int, p: dict) -> Tree:
    tree = Tree.empty(model.depth)
    open_nodes = _summed(model, rows, staged, tree, 0, [1], turn, p["subsample"])
    totals = {1: open_nodes[1][:, 0].sum(axis=1)}
    for level in range(model.depth + 1):
        parents = {}
        for node, (g, tree.cover[node]) in ((k, x / UNIT) for k, x in totals.items()):
            tree.value[node] = -p["eta"] * g / (tree.cover[node] + p["reg_lambda"])
            split = level < model.depth and best_split(*(open_nodes[node] / UNIT), p["gamma"], p["min_child_weight"], p["reg_lambda"])
            if split:
                tree.gain[node], tree.feature[node], tree.bin[node], tree.missing_left[node] = split
                parents[node] = open_nodes[node]
        before, totals = totals, {}
        for node, sums in parents.items():
            f, cut = tree.feature[node], tree.bin[node]
            left = sums[:, f, 0 if tree.missing_left[node] else 1:cut + 1].sum(axis=1)
            totals |= {2 * node: left, 2 * node + 1: before[node] - left}
        if not totals:
            break
        if level + 1 < model.depth:
            lighter = [2 * k + int(totals[2 * k + 1][1] < totals[2 * k][1]) for k in parents]
            open_nodes = _summed(model, rows, staged, tree, level + 1, lighter, turn, p["subsample"])
            open_nodes |= {k ^ 1: parents[k // 2] - open_nodes[k] for k in lighter}
    return tree


def loss_sums(model: Boosted):
    """(loss, n) of a task's binned rows: log-loss in units of 2^-24."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = n = 0
        for batch in batches:
            for block in _blocks(batch, len(model.cols)):
                y, margin = block["y"], model.margin(block["bins"])
                loss += int(np.rint(np.logaddexp(0, np.where(y == 1, -margin, margin)) * UNIT).sum())
                n += len(y)
        yield pa.RecordBatch.from_arrays([pa.array([loss], pa.int64()), pa.array([n], pa.int64())], ["loss", "n"])
    return run


def _margins(model: Boosted, staged: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = [(x["margin"] + model.margin(x["bins"], staged)).tobytes() for x in _blocks(batch, len(model.cols))]
            yield batch.set_column(3, "margin", pa.array(margin, pa.binary()))
    return run


_BINNED = "u binary, y binary, bins binary, margin binary"


@dataclass
class Run:
    """A fit that can be carried on: the model so far, its blocks of binned rows, the settings, and how many trees the rows' margins hold."""

    model: Boosted
    rows: DataFrame
    params: dict
    staged: int = 0


def settings(reg_lambda: float = 1.0, **params) -> dict:
    p = {**PARAMS, "reg_lambda": reg_lambda, **params}
    if unknown := set(p) - set(PARAMS) - {"reg_lambda"}:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    return p


def binned(df: DataFrame, cols: list[str], label: str = "is_churn", key: str = "msno", seed: int = 42, max_bins: int = 64,
           edges: list[np.ndarray] | None = None) -> tuple[list[np.ndarray], DataFrame]:
    """The bin edges (fitted on ``df`` where not given) and the rows with a label 0 or 1, binned and written in blocks. The
    blocks are dealt over all cores: a frame of few files would leave most of them idle in every pass."""
    if not 1 <= max_bins <= 255:
        raise ValueError("max_bins must be between 1 and 255")
    ship_package(df.sparkSession)
    rows = df.where(F.col(label).isin(0, 1))
    edges = fit_edges(rows, cols, max_bins) if edges is None else edges
    rows = rows.select(F.coalesce(key_hash(key, seed), F.lit(0)).alias("u"), F.col(label).cast("double").alias("y"), *_inputs(cols))
    blocks = rows.mapInArrow(_binned(Boosted(cols, edges, 0)), _BINNED)
    return edges, cut_lineage(blocks.repartition(df.sparkSession.sparkContext.defaultParallelism), "binned")


def carry_on(run: Run, rounds: int) -> Run:
    """Trees are grown until the model has ``rounds``: the same ones, however often the fit stops between."""
    for turn in range(len(run.model.trees), rounds):
        if turn and turn % STAGED == 0:
            run.rows = cut_lineage(run.rows.mapInArrow(_margins(run.model, run.staged), _BINNED), "margins")
            run.staged = turn
        run.model.trees.append(_grow(run.model, run.rows, run.staged, turn, run.params))
    return run


def train_boosted(train: DataFrame, cols: list[str], label: str = "is_churn", key: str = "msno", seed: int = 42, max_bins: int = 64,
                  reg_lambda: float = 1.0, **params) -> Boosted:
    """Fit on the rows of ``train`` that have a label 0 or 1. ``params`` as in ``PARAMS``."""
    p = settings(reg_lambda, **params)
    edges, rows = binned(train, cols, label, key, seed, max_bins)
    return carry_on(Run(Boosted(cols, edges, p["max_depth"]), rows, p), p["num_round"]).model


def score_boosted(model: Boosted, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` with ``score`` (P(class 1)) and ``prediction``."""
    ship_package(df.sparkSession)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = 1 / (1 + np.exp(-model.margin(model.bins(batch))))
            own = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(score), pa.array((score >= threshold).astype(float))], [*names, "score", "prediction"])

    schema = T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("prediction", T.DoubleType())])
    return df.select("*", *_inputs(model.cols)).mapInArrow(run, schema)


def tree_rows(model: Boosted) -> list[tuple]:
    """(tree, node, feature, threshold, missing_left, gain, cover, value) of every node; a leaf has no feature."""
    out = []
    for k, t in enumerate(model.trees):
        for n in np.flatnonzero(t.cover > 0).tolist():
            f = int(t.feature[n])
            # A split after the last edge parts the values that are there from the missing ones.
            above = f >= 0 and t.bin[n] - 1 < len(model.edges[f])
            out.append((k, n, model.cols[f] if f >= 0 else None, float(model.edges[f][t.bin[n] - 1]) if above else None,
                        bool(t.missing_left[n]) if f >= 0 else None, float(t.gain[n]), float(t.cover[n]), None if f >= 0 else float(t.value[n])))
    return out


TREE_SCHEMA = "tree int, node int, feature string, threshold double, missing_left boolean, gain double, cover double, value double"
