"""Exact order statistics without a sort and without a table of distinct values.

``kth_smallest``: whole numbers, by repeated histograms. Values are non-negative and below ``2^BITS``. A pass counts them by their next
``STEP`` bits within the ranges that still hold a wanted rank; after
``BITS / STEP`` passes each range is one value. A pass is one aggregate with
map-side combine whose result has at most ``2^STEP`` rows for each rank, so
nothing is sorted and the shuffle does not grow with the data.

``quantile_values``: quantiles of any doubles of all columns at once, by narrowing
ranges. A sketch only proposes two cuts around a rank; the rows below, at and between
them are counted exactly, so the rank is known to lie at a cut (a hot value ends the search
there) or in an open range between cuts, and a wrong proposal costs a round, never a
wrong result. A range of at most ``limit`` rows is read out by one aggregate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, STEP = 60, 12


def kth_smallest(df: DataFrame, value: Column, ranks: list[int]) -> list[int]:
    """The values at ``ranks`` (from 1, at most the number of rows), in the order of ``ranks``."""
    rows = df.select(value.cast("long").alias("v"))
    known = {r: (0, r) for r in ranks}  # the leading bits found so far, the rank among the values that have them
    for shift in range(BITS - STEP, -1, -STEP):
        above = F.shiftright("v", shift + STEP)
        open_ranges = sorted({prefix for prefix, _ in known.values()})
        counts = (rows.where(above.isin(open_ranges)).groupBy(F.shiftright("v", shift).alias("b"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())
        counts = sorted((r["b"], r["n"]) for r in counts)
        for rank, (prefix, left) in known.items():
            for b, n in counts:
                if b >> STEP == prefix:
                    if left <= n:
                        known[rank] = (b, left)
                        break
                    left -= n
    return [known[r][0] for r in ranks]


@dataclass
class _Search:
    """Ranks (from 1) of one column that lie in the open range (lo, hi), None where it has no end."""
    ranks: list[int]
    inside: int
    below: int = 0
    lo: float | None = None
    hi: float | None = None
    cuts: tuple[float, float] | None = None
    found: dict[int, float] = field(default_factory=dict)

    def narrow(self, less: int, first: int, between: int, second: int) -> None:
        """Go on in the part that holds the ranks. Neighbouring ranks lie in one part, or at a cut and
        beside it, since every cut is a value of the range."""
        a, b = self.cuts
        ends = [self.below + less]
        ends += [ends[0] + first, ends[0] + first + between, ends[0] + first + between + second]
        parts = [(self.lo, a, self.below, less), None, (a, b, ends[1], between), None,
                 (b, self.hi, ends[3], self.inside - (ends[3] - self.below))]
        left, go_on = [], None
        for r in self.ranks:
            at = sum(r > e for e in ends)
            if parts[at] is None:
                self.found[r] = a if at == 1 else b
            else:
                left.append(r)
                go_on = parts[at]
        self.ranks, self.cuts = left, None
        if go_on:
            self.lo, self.hi, self.below, self.inside = go_on


_BOUNDS = "column string, lo array<double>, hi array<double>, a array<double>, b array<double>, low array<int>, high array<int>"


def quantile_values(pairs: DataFrame, probs: list[float], limit: int = 100_000, accuracy: int = 10_000,
                    grid: int = 500) -> dict[str, tuple[int, list[float]]]:
    """{column: (n, quantiles)} of (column, v double) rows, NULL values left out: linear
    interpolation between the order statistics around rank (n - 1) p + 1.

    ``pairs`` is read once for counts and first cuts, once to count around the cuts and once to read out,
    or twice more for each further narrowing (by about ``grid`` / 2) that ranges above ``limit`` rows
    need: three reads up to about ``limit * accuracy / 3`` rows. A read gives one row for each column and task
    to the shuffle. Columns without values are not in the result; ties and hot values need no
    care; NaN is not for ranking, make it NULL.
    """
    pairs = pairs.where(F.col("v").isNotNull())
    spark, slots = pairs.sparkSession, range(len(probs))
    around = [min(1.0, max(0.0, p + d)) for p in probs for d in (-1.5 / accuracy, 1.5 / accuracy)]
    start = pairs.groupBy("column").agg(F.count("v").alias("n"), F.percentile_approx("v", around, accuracy).alias("cuts")).collect()
    sizes = {r["column"]: r["n"] for r in start}
    searches = {}
    for r in start:
        for i, p in enumerate(probs):
            h = (r["n"] - 1) * float(p) + 1
            searches[r["column"], i] = _Search(sorted({math.floor(h), math.ceil(h)}), r["n"], cuts=tuple(r["cuts"][2 * i:2 * i + 2]))

    def placed(active: dict) -> DataFrame:
        """Rows beside their column's searches; a search that is not ``active`` has no row in its range."""
        rows = []
        for c in sorted({c for c, _ in active}):
            mine = [active.get((c, i)) for i in slots]
            ends = [(s.lo, s.hi) if s else (math.inf, -math.inf) for s in mine]
            cuts = [(s and s.cuts) or (None, None) for s in mine]
            places = [(s.ranks[0] - s.below, s.ranks[-1] - s.below) if s and s.inside <= limit else (None, None) for s in mine]
            rows.append((c, *[[x[k] for x in pairs_of] for pairs_of in (ends, cuts, places) for k in (0, 1)]))
        return pairs.join(F.broadcast(spark.createDataFrame(rows, _BOUNDS)), "column")  # one row for each column

    def within(i: int) -> Column:
        lo, hi = F.col("lo")[i], F.col("hi")[i]
        return (lo.isNull() | (F.col("v") > lo)) & (hi.isNull() | (F.col("v") < hi))

    while True:
        wide = {k: s for k, s in searches.items() if s.ranks and s.inside > limit}
        if not wide:
            break
        uncut = {k: s for k, s in wide.items() if s.cuts is None}
        if uncut:
            steps = [j / grid for j in range(grid + 1)]
            got = placed(uncut).groupBy("column").agg(*[
                F.percentile_approx(F.when(within(i), F.col("v")), steps, 4 * grid).alias(f"g{i}") for i in slots]).collect()
            for r in got:
                for i in slots:
                    s = uncut.get((r["column"], i))
                    if s:
                        at = (s.ranks[0] - s.below) / s.inside * grid
                        s.cuts = (r[f"g{i}"][max(0, math.floor(at) - 1)], r[f"g{i}"][min(grid, math.ceil(at) + 1)])
        v = F.col("v")
        counts = placed(wide).groupBy("column").agg(*[F.count_if(within(i) & test).alias(f"{name}{i}") for i in slots for name, test in (
            ("less", v < F.col("a")[i]), ("first", v == F.col("a")[i]),
            ("between", (v > F.col("a")[i]) & (v < F.col("b")[i])), ("second", (v > F.col("a")[i]) & (v == F.col("b")[i])))]).collect()
        for r in counts:
            for i in slots:
                if (r["column"], i) in wide:
                    wide[r["column"], i].narrow(*[r[f"{name}{i}"] for name in ("less", "first", "between", "second")])

    small = {k: s for k, s in searches.items() if s.ranks}
    if small:
        values = [F.sort_array(F.collect_list(F.when(within(i), F.col("v")))) for i in slots]  # at most ``limit`` each
        got = placed(small).groupBy("column").agg(*[
            F.try_element_at(values[i], F.max(F.col(name)[i])).alias(f"{name}{i}") for i in slots for name in ("low", "high")]).collect()
        for r in got:
            for i in slots:
                s = small.get((r["column"], i))
                if s:
                    s.found.update({s.ranks[0]: r[f"low{i}"], s.ranks[-1]: r[f"high{i}"]})

    out = {}
    for c, n in sizes.items():
        values = []
        for i, p in enumerate(probs):
            h, found = (n - 1) * float(p) + 1, searches[c, i].found
            lo, hi = found[math.floor(h)], found[math.ceil(h)]
            values.append(lo + (hi - lo) * (h - math.floor(h)) if lo != hi else lo)
        out[c] = (n, values)
    return out
