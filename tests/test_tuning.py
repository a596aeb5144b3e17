"""Hyperband: brackets, warm starts against whole fits, the validation loss."""

import math

import numpy as np
import pytest

from churnlab.operators import boosting as B
from churnlab.operators import tuning

from test_boosting import COLS, data


def test_brackets():
    assert tuning.brackets() == [(9, [1, 3, 10]), (5, [3, 10]), (3, [10])]
    assert tuning.brackets(n_trials=6) == [(3, [1, 3, 10]), (2, [3, 10]), (1, [10])]
    assert tuning.brackets(n_trials=1) == [(1, [1, 3, 10])]
    assert tuning.brackets(1, 81, 3)[0] == (81, [1, 3, 9, 27, 81]) and tuning.brackets(4, 4) == [(1, [4])]
    for n in range(1, 40):
        assert sum(k for k, _ in tuning.brackets(n_trials=n)) == n
    for bad in [(0, 5, 3), (6, 5, 3), (1, 5, 1)]:
        with pytest.raises(ValueError):
            tuning.brackets(*bad)


def frames(spark):
    schema = "msno string, a double, b double, c double, is_churn int, y string"
    return (spark.createDataFrame(data(0, 400), schema).repartition(3), spark.createDataFrame(data(1, 200) + [("none", 1.0, 1.0, 1.0, None, "")], schema))


def test_carried_on_fit_is_the_whole_fit(spark, monkeypatch):
    """Also where margins are written anew between the stops."""
    monkeypatch.setattr(B, "STAGED", 2)
    train, _ = frames(spark)
    own = dict(max_depth=2, gamma=0.0)
    edges, rows = B.binned(train, COLS, max_bins=8)
    p = B.settings(**own)
    run = B.Run(B.Boosted(COLS, edges, 2), rows, p)
    for rounds in (1, 2, 2, 5):
        assert len(B.carry_on(run, rounds).model.trees) == rounds
    assert B.tree_rows(run.model) == B.tree_rows(B.train_boosted(train, COLS, max_bins=8, num_round=5, **own))


def test_hyperband(spark):
    train, valid = frames(spark)
    table, winner = tuning.hyperband(train, valid, COLS, n_trials=5, max_iter=4, eta=2, max_bins=8, gamma=0.0)
    rows = table.collect()
    plan = tuning.brackets(1, 4, 2, 5)
    assert {(r.bracket, r.rung, r.num_round) for r in rows} == {(b, k, n) for b, (_, rungs) in enumerate(plan) for k, n in enumerate(rungs)}
    longest = {}
    for r in rows:
        longest[r.trial] = max(longest.get(r.trial, 0), r.num_round)
    assert len(longest) == 5 and sum(r.trees_grown for r in rows) == sum(longest.values())
    for b, (n, rungs) in enumerate(plan):  # the best go on
        alive = None
        for k in range(len(rungs)):
            own = [r for r in rows if (r.bracket, r.rung) == (b, k)]
            assert len(own) == n if alive is None else {r.trial for r in own} == alive
            alive = {r.trial for r in sorted(own, key=lambda r: (r.val_logloss, r.trial))[:max(1, len(own) // 2)]}
    (best,) = [r for r in rows if r.best]
    assert best.val_logloss == min(r.val_logloss for r in rows) and len(winner.trees) == best.num_round
    whole = B.train_boosted(train, COLS, max_bins=8, num_round=best.num_round, max_depth=best.max_depth, eta=best.step_size, gamma=0.0)
    assert B.tree_rows(whole) == B.tree_rows(winner)
    scored = [(r.score, r.is_churn) for r in B.score_boosted(winner, valid).collect() if r.is_churn is not None]
    assert best.val_logloss == pytest.approx(np.mean([-math.log(s if y else 1 - s) for s, y in scored]), abs=1e-6)
    with pytest.raises(ValueError):
        tuning.hyperband(train, valid.limit(0), COLS, n_trials=1, max_iter=1)
    with pytest.raises(ValueError):
        tuning.hyperband(train, valid, COLS, n_trials=0)
