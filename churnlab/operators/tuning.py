"""M3: Hyperband over the second-order trees, with fits that are carried on.

A trial is a learning rate in (0, 1) and a depth in [1, 10], drawn with a seed. A
bracket starts some trials at few boosting rounds and lets the best ``1/eta`` of
them go on at every rung, up to the most rounds; brackets differ in how many
trials they start and at how many rounds. A trial that goes on keeps its trees and
grows only the new ones: what it has then is what one fit of that many rounds gives, so the
trees grown in all are those of every trial's longest run.

Columns are binned once for all trials, training and validation rows alike, and
written. A rung's trials run as Spark jobs submitted from a small thread pool; the
validation loss is one aggregate of whole numbers, the same however rows are dealt.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators import boosting
from churnlab.operators.boosting import Boosted, Run

TRIAL_SCHEMA = ("bracket int, rung int, trial int, step_size double, max_depth int, num_round int, trees_grown int, "
                "val_logloss double, best boolean")


def brackets(min_iter: int = 1, max_iter: int = 10, eta: int = 3, n_trials: int | None = None) -> list[tuple[int, list[int]]]:
    """(trials, rounds at each rung) of every bracket, the one that starts most trials
    first. ``n_trials`` deals that many trials over the brackets in proportion (largest
    remainders, earlier brackets first); a bracket without a trial is left out."""
    if not 1 <= min_iter <= max_iter or eta < 2:
        raise ValueError("1 <= min_iter <= max_iter and eta >= 2 are needed")
    top = 0
    while min_iter * eta ** (top + 1) <= max_iter:
        top += 1
    out = [(math.ceil((top + 1) * eta**s / (s + 1)), [max(min_iter, max_iter // eta ** (s - i)) for i in range(s + 1)])
           for s in range(top, -1, -1)]
    if n_trials is not None:
        whole = sum(n for n, _ in out)
        dealt = [n_trials * n // whole for n, _ in out]
        by_remainder = sorted(range(len(out)), key=lambda b: (-(n_trials * out[b][0] % whole), b))
        for b in by_remainder[:n_trials - sum(dealt)]:
            dealt[b] += 1
        out = [(n, rounds) for n, (_, rounds) in zip(dealt, out) if n]
    return out


def drawn_trials(n: int, seed: int) -> list[dict]:
    rnd = random.Random(seed)
    return [dict(eta=round(rnd.uniform(0.01, 0.99), 4), max_depth=rnd.randint(1, 10)) for _ in range(n)]


def validation_loss(model: Boosted, rows: DataFrame) -> float:
    """Mean log-loss of binned rows."""
    sums = rows.select("bins", "y").mapInArrow(boosting.loss_sums(model), "loss long, n long")
    got = sums.agg(F.sum(F.col("loss").cast("decimal(38, 0)")).alias("loss"), F.sum("n").alias("n")).first()
    if not got["n"]:
        raise ValueError("no validation row has a label 0 or 1")
    return float(got["loss"]) / boosting.UNIT / got["n"]


def hyperband(train: DataFrame, valid: DataFrame, cols: list[str], label: str = "is_churn", key: str = "msno", n_trials: int | None = 6,
              parallel: int = 3, min_iter: int = 1, max_iter: int = 10, eta: int = 3, seed: int = 42, max_bins: int = 64,
              **params) -> tuple[DataFrame, Boosted]:
    """A row for each (bracket, rung, trial) with the validation loss and the trees grown for
    it, and the model of the row with the smallest loss (ties: fewer rounds, the earlier
    trial). ``n_trials=None`` runs whole brackets. Other ``params`` as in ``boosting.PARAMS``.

    Rows without a label 0 or 1 take no part; a validation frame without any
    other row raises."""
    spark = train.sparkSession
    plan = brackets(min_iter, max_iter, eta, n_trials)
    if not plan:
        raise ValueError("n_trials must be at least 1")
    edges, rows = boosting.binned(train, cols, label, key, seed, max_bins)
    held_out = boosting.binned(valid, cols, label, key, seed, max_bins, edges)[1]
    drawn = drawn_trials(sum(n for n, _ in plan), seed)
    out, runs = [], {}

    def rung(trial: int, rounds: int) -> tuple[float, int, int]:
        run = runs[trial]
        had = len(run.model.trees)
        boosting.carry_on(run, rounds)
        return validation_loss(run.model, held_out), trial, rounds - had

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for b, (n, rungs) in enumerate(plan):
            alive = list(range(len(runs), len(runs) + n))
            for t in alive:
                p = boosting.settings(**{**params, **drawn[t]})
                runs[t] = Run(Boosted(cols, edges, p["max_depth"]), rows, p)
            for r, rounds in enumerate(rungs):
                done = list(pool.map(lambda t: rung(t, rounds), alive))
                out += [(b, r, t, drawn[t]["eta"], drawn[t]["max_depth"], rounds, grown, loss) for loss, t, grown in done]
                alive = [t for _, t, _ in sorted(done)[:max(1, len(alive) // eta)]]
    best = min(out, key=lambda x: (x[7], x[5], x[2]))
    model = runs[best[2]].model
    winner = Boosted(model.cols, model.edges, model.depth, model.trees[:best[5]])
    return spark.createDataFrame([(*x, x is best) for x in out], TRIAL_SCHEMA), winner
