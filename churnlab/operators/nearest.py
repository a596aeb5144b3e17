"""Exact nearest neighbours by a metric join: pivots, rings, blocks.

Points are arrays of whole numbers (``on_grid`` makes them from doubles), so
distances are exact and ties are settled by the smallest key. Of the targets a
bounded number is drawn as pivots. A target belongs to the cell of its nearest
pivot and, by its distance from it, to a ring of that cell; a ring with many
targets is dealt into blocks of bounded size. A query looks into one block near
it first, which bounds its distance. Then the triangle inequality tells which
rings can hold a nearer target, and the query goes to the blocks of those alone.
Within a task a chunk of queries meets a block of targets in numpy and only
each query's best is given out. Equal points are one point, so copies cost
nothing. Neither a hot region nor a hot point is ever gathered in one task, and
no pairs of points become rows.

Pivots, and the extents of at most ``pivots * RINGS`` rings, are all that comes to
the driver; they change the work and never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators.prep import fit_standardizer, present
from churnlab.session import cut_lineage, ship_package

RINGS = 64
#: Targets in a block and queries in a chunk, on average.
BLOCK = 2048
_FOUND = "v array<long>, d2 long, key string, value double"


def on_grid(df: DataFrame, cols: list[str], out: str = "v", steps: int = 1000) -> DataFrame:
    """``out``: the standardised columns on a grid of ``steps`` to one standard
    deviation; missing values (NULL, NaN) are at the mean. Two scans, a few numbers
    a column to the driver."""
    stats = fit_standardizer(df, cols)
    z = []
    for c in cols:
        m, s = stats[c]
        z.append(F.coalesce(F.round((present(c) - F.lit(m)) / F.lit(s if s else 1.0) * steps), F.lit(0.0)).cast("long"))
    return df.withColumn(out, F.array(*z))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten()).astype(np.int64).reshape(-1, dim)


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` from all rows of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        out += d * d
    return out


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel(), pa.int64()))


def _cells(pivots: np.ndarray):
    """Adds the nearest pivot (``cell``) and the distance from it (``r``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, r = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            points = _matrix(batch.column("v"), pivots.shape[1])
            for a in range(0, len(points), 4096):
                d = _square(points[a:a + 4096], pivots)
                cell[a:a + 4096] = d.argmin(axis=1)
                r[a:a + 4096] = np.sqrt(d.min(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(r)], [*batch.schema.names, "cell", "r"])
    return run


class Rings:
    """The pivots, and the rings that hold targets: cell, ring, extent, blocks."""

    def __init__(self, pivots: np.ndarray, rows: list):
        self.pivots = pivots
        self.cell = np.array([r["cell"] for r in rows], np.int64)
        self.low, self.high = np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows])
        self.blocks = np.array([r["blocks"] for r in rows], np.int64)
        #: A block's number: that of its ring, then its own within the ring.
        self.base = (self.cell * RINGS + np.array([r["ring"] for r in rows], np.int64)) << 32

    def home(self, points: np.ndarray) -> np.ndarray:
        """One block near each point: of the ring next to it in the nearest cell."""
        d = np.sqrt(_square(points, self.pivots))
        own, out = d.argmin(axis=1), np.zeros(len(points), np.int64)
        for k, (p, c) in enumerate(zip(points, own)):
            rings = np.flatnonzero(self.cell == c)
            off = np.maximum(np.maximum(self.low[rings] - d[k, c], d[k, c] - self.high[rings]), 0)
            j = rings[off.argmin()]
            out[k] = self.base[j] + int(np.abs(p).sum()) % self.blocks[j]
        return out

    def open(self, points: np.ndarray, bound: np.ndarray, seen: np.ndarray) -> list[list[int]]:
        """Blocks other than ``seen`` that can hold a target within ``bound`` of each point."""
        d = np.sqrt(_square(points, self.pivots))
        to = d[:, self.cell]
        least = np.maximum(np.maximum(to - self.high, self.low - to), (to - d.min(axis=1)[:, None]) / 2)
        near = least <= bound[:, None] * (1 + 1e-9) + 1e-6  # rounding of the roots only adds blocks
        return [[b for j in np.flatnonzero(row) for b in range(self.base[j], self.base[j] + self.blocks[j]) if b != s]
                for row, s in zip(near, seen.tolist())]


def _homes(rings: Rings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v"), rings.pivots.shape[1])
            block = [rings.home(points[a:a + 4096]) for a in range(0, len(points), 4096)]
            yield pa.RecordBatch.from_arrays([batch.column("v"), pa.array(np.concatenate(block) if block else [], pa.int64())], ["v", "block"])
    return run


def _opened(rings: Rings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v"), rings.pivots.shape[1])
            bound, seen = np.sqrt(np.asarray(batch.column("d2")).astype(float)), np.asarray(batch.column("block"))
            for a in range(0, len(points), 1024):
                found = rings.open(points[a:a + 1024], bound[a:a + 1024], seen[a:a + 1024])
                yield pa.RecordBatch.from_arrays([batch.column("v").slice(a, len(found)), pa.array(found, pa.list_(pa.int64()))], ["v", "blocks"])
    return run


def _meet(dim: int):
    """The best target of a block for each query of a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                queries, targets = _matrix(batch.column("queries")[k].values, dim), batch.column("targets")[k].values
                keys = targets.field("key").to_pylist()
                order = np.array(sorted(range(len(keys)), key=keys.__getitem__))  # the first of equal distances has the smallest key
                points, values = _matrix(targets.field("v"), dim)[order], targets.field("value").to_pylist()
                best, far = [], []
                for a in range(0, len(queries), 256):
                    d = _square(queries[a:a + 256], points)
                    best.append(order[d.argmin(axis=1)])
                    far.append(d.min(axis=1))
                at = np.concatenate(best).tolist()
                yield pa.RecordBatch.from_arrays(
                    [_lists(queries), pa.array(np.concatenate(far)), pa.array([keys[i] for i in at], pa.string()),
                     pa.array([values[i] for i in at], pa.float64())], ["v", "d2", "key", "value"])
    return run


def _met(queries: DataFrame, blocks: DataFrame, dim: int, size: int) -> DataFrame:
    """(v, d2, key, value) of queries (v, block) in their blocks."""
    chunks = queries.groupBy("block").agg(F.ceil(F.count("*") / size).alias("chunks"))
    dealt = queries.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("v"), F.col("chunks")))
    packed = dealt.groupBy("block", "chunk").agg(F.collect_list("v").alias("queries"))
    return packed.join(blocks, "block").select("queries", "targets").mapInArrow(_meet(dim), _FOUND)


def nearest_points(queries: DataFrame, targets: DataFrame, pivots: int = 256, block: int = BLOCK) -> DataFrame:
    """(v, d2, key, value): for every distinct point ``v`` of ``queries`` the nearest of
    ``targets`` (v array<long>, key string, value double), its squared distance, and of
    equally near ones that with the smallest key. Points must have the same length, and
    coordinates below 10^8. No targets: no rows."""
    spark = queries.sparkSession
    ship_package(spark)
    points = cut_lineage(targets.groupBy("v").agg(F.min(F.struct("key", "value")).alias("best"))
                         .select("v", "best.key", "best.value"), "targets")
    drawn = [r["v"] for r in points.select("v").orderBy(F.xxhash64("v"), "v").limit(pivots).collect()]
    if not drawn:
        return spark.createDataFrame([], _FOUND)
    centre = np.array(drawn, np.int64)
    placed = cut_lineage(points.mapInArrow(_cells(centre), "v array<long>, key string, value double, cell int, r double"), "cells")
    width = placed.agg(F.avg("r") / 2).first()[0] or 1.0
    placed = placed.withColumn("ring", F.least(F.floor(F.col("r") / F.lit(width)), F.lit(RINGS - 1)).cast("int"))
    extents = placed.groupBy("cell", "ring").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.ceil(F.count("*") / block).alias("blocks"))
    extents = cut_lineage(extents, "rings")
    rings = Rings(centre, extents.orderBy("cell", "ring").collect())
    number = (F.col("cell").cast("long") * RINGS + F.col("ring")) * F.lit(1 << 32) + F.pmod(F.xxhash64("v"), F.col("blocks"))
    blocks = cut_lineage(placed.join(F.broadcast(extents.select("cell", "ring", "blocks")), ["cell", "ring"])
                         .withColumn("block", number).groupBy("block")
                         .agg(F.collect_list(F.struct("v", "key", "value")).alias("targets")), "blocks")
    asked = queries.select("v").distinct()
    homes = cut_lineage(asked.mapInArrow(_homes(rings), "v array<long>, block long"), "homes")
    # A block's points are dealt by hash, so the one that a query was sent to may hold none; then its neighbour does.
    homes = homes.join(blocks.select("block", F.lit(True).alias("there")), "block", "left")
    known = cut_lineage(_met(homes.where("there").select("v", "block"), blocks, centre.shape[1], block), "near")
    bounded = homes.join(known.select("v", "d2"), "v", "left").select("v", F.coalesce("d2", F.lit((1 << 62))).alias("d2"), "block")
    more = bounded.mapInArrow(_opened(rings), "v array<long>, blocks array<long>").select("v", F.explode("blocks").alias("block"))
    found = known.unionByName(_met(more, blocks, centre.shape[1], block))
    best = found.groupBy("v").agg(F.min(F.struct("d2", "key", "value")).alias("b"))
    return best.select("v", "b.d2", "b.key", "b.value")
