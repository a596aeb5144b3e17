"""Removed bytes against a look-up of every string."""

import random

import numpy as np
import pytest

from churnlab.llm._anchors import runs
from churnlab.llm.suffix_dedup import suffix_dedup

from .frames import AWKWARD, frame, random_texts


def brute(rows, width):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - width + 1):
            x = raw[p:p + width]
            if x in seen:
                gone[p:p + width] = True
            seen.add(x)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
        spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
        out.append((i, len(raw), int(gone.sum()), spans, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return out


def got(df, width):
    return [(r[0], r[1], r[2], [tuple(x) for x in r[3]], bytes(r[4])) for r in suffix_dedup(df, width=width).collect()]


@pytest.mark.parametrize("seed,width", [(1, 100), (2, 70)])
def test_against_brute_force(spark, seed, width):
    rows = random_texts(150, seed)
    rows[3] = (3, "ab" * 400)          # periodic: strings repeat inside the document
    rows[5] = (5, rows[4][1] + rows[4][1])
    assert sorted(got(frame(spark, rows), width)) == sorted(brute(rows, width))


def test_common_passage_in_different_contexts(spark):
    """Shared passages just below, at and above the threshold, everywhere."""
    rnd = random.Random(5)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(101))
    rows = [(i, "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 80))) + passage[:99 + i % 3]
             + "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 80)))) for i in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(got(frame(spark, rows).repartition(17), 100)) == sorted(brute(rows, 100))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_awkward(spark):
    key = lambda r: (str(r[0]), r[4])
    assert sorted(got(frame(spark, AWKWARD), 100), key=key) == sorted(brute(AWKWARD, 100), key=key)
    assert suffix_dedup(frame(spark, AWKWARD).limit(0)).count() == 0


def test_buffers_of_long_texts(spark, monkeypatch):
    """A text longer than a buffer is cut into overlapping ones."""
    rnd = random.Random(7)
    part = "".join(rnd.choice("abcdef") for _ in range(700_000))
    rows = [(1, part + part), (2, "q" + part[1000:2000])]
    assert sorted(got(frame(spark, rows), 100)) == sorted(brute(rows, 100))


def test_runs_depend_on_content_only():
    rnd = np.random.default_rng(0)
    x = rnd.integers(97, 100, 400).astype(np.uint8)
    pad = rnd.integers(97, 100, 50).astype(np.uint8)
    def at(buf):
        a, s, n = runs(buf, 100, 64)
        return {bytes(buf[p:p + 100]): h for h, q, m in zip(a, s, n) for p in range(q, q + m)}
    one, two = at(x), at(np.concatenate((pad, x)))
    assert len(one) == 301 and all(two[w] == h for w, h in one.items())
