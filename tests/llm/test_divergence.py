"""Source divergence against plain Python with whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from churnlab.llm import divergence
from churnlab.llm.divergence import source_divergence, term_texts

SCHEMA = "doc_id long, text string, lang string, source string, _k int, idx int, term string, terms string, n string, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, s, 1, 2, "a", "b", "c", "d") for i, (t, g, s) in enumerate(rows)], SCHEMA).repartition(3)


def brute(rows, min_docs=3, top=200):
    docs = [(g or "", s or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")])
            for t, g, s in rows]
    out = []
    for lang in {g for g, _, _ in docs}:
        own = [(s, w) for g, s, w in docs if g == lang]
        df = Counter(x for _, w in own for x in set(w))
        kept = {x for x, n in df.items() if n >= min_docs}
        count = defaultdict(Counter)
        whole = Counter()
        for s, w in own:
            count[s].update(x for x in w if x in kept)
            whole.update(x for x in w if x in kept)
        share = lambda c: {x: 1 + 10**9 * (c[x] + 1) // (sum(c.values()) + len(kept)) for x in kept}
        q, ps = share(whole), {s: share(count[s]) for s in count}
        f = lambda a, b: (a - b) ** 2 // b
        for s, p in ps.items():
            pairs = [(sum(f(p[x], r[x]) for x in kept), t) for t, r in ps.items() if t != s]
            terms = [(f(p[x], q[x]), x) for x in kept if count[s][x] and p[x] > q[x]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, x, v, k + 1) for k, (v, x) in enumerate(items[:limit])]
    return sorted(out)


def made(seed, n, words=80):
    rnd = random.Random(seed)
    vocabulary = [rnd.choice(["w", "É", "日", "Zz"]) + "".join(rnd.choice("abcdé") for _ in range(3)) for _ in range(words)]
    rows = []
    for _ in range(n):
        lang = rnd.choice(["en", "en", "de", None, ""])
        source = rnd.choice(["hot"] * 4 + ["a", "b", None, "Ä", "rare"])
        bias = vocabulary[: 20 if source == "a" else words]
        rows.append((" ".join(rnd.choice(bias) for _ in range(rnd.randint(0, 30))) + rnd.choice([" 12 a-b x_y", "", "\n[t]~"]), lang, source))
    return rows


AWKWARD = [(None, None, None), ("", "en", "a"), ("12 3", "en", "b"), ("one two", "xx", "solo"), ("a a a", "yy", "p"), ("a b", "yy", "q"),
           ("a b", "yy", "q"), ("c " * 40_000, "yy", "long"), ("c", "yy", "q"), ("C", "yy", "p")]


@pytest.mark.parametrize("rows", [made(1, 150), made(2, 40), AWKWARD, made(3, 60) + AWKWARD])
def test_against_plain(spark, rows):
    assert sorted(map(tuple, source_divergence(frame(spark, rows)).collect())) == brute(rows)


def test_slices_and_blocks(spark, monkeypatch):
    """Vocabularies dealt to many slices, terms to many blocks, few ranks."""
    monkeypatch.setattr(divergence, "BLOCK_ENTRIES", 20)
    written, put = [], divergence._written
    monkeypatch.setattr(divergence, "_written", lambda rows, name, *parts: written.append(name) or put(rows, name, *parts))
    rows = made(4, 120, 400)
    got = source_divergence(frame(spark, rows), min_docs=2, top_terms=5, max_terms=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 5)
    assert written.count("slices") >= 2


def test_empty(spark):
    assert source_divergence(frame(spark, AWKWARD).limit(0)).count() == 0
    assert term_texts(frame(spark, AWKWARD).limit(0), "text", "lang", "source")[1] == {}


def test_shares_are_exact(spark):
    """Counts beyond what a product in 64 bits holds."""
    n, total, v = 9_000_000_000_000_000, 10_000_000_000_000_000, 123_456_789
    got = spark.range(1).selectExpr(f"{n}L as n", f"{total}L as t", f"{v}L as v").select(divergence.share("n", "t", "v")).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + v)


def test_group_sums_given_out(monkeypatch):
    """Sums that are given out in parts add up to the whole."""
    monkeypatch.setattr(divergence, "HELD_ENTRIES", 30)
    rnd, want, batches = np.random.default_rng(1), Counter(), []
    for _ in range(12):
        rows = [(f"s{rnd.integers(3)}", sorted(rnd.choice(40, rnd.integers(0, 9), replace=False).tolist())) for _ in range(5)]
        values = [[float(rnd.integers(1, 9)) for _ in i] for _, i in rows]
        for (s, i), v in zip(rows, values):
            want.update({(s, x): int(y) for x, y in zip(i, v)})
        batches.append(pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows]), pa.array([i for _, i in rows], pa.list_(pa.int32())),
                                                   pa.array(values, pa.list_(pa.float64()))], ["source", "indices", "values"]))
    got, parts = Counter(), list(divergence._group_sums(iter(batches)))
    for b in parts:
        for s, i, n in zip(*(b.column(c).to_pylist() for c in ("source", "idx", "n"))):
            got[s, i] += n
    assert got == want and len(parts) > 1 and not list(divergence._group_sums(iter([])))


def test_pair_sums_of_a_block():
    rnd = np.random.default_rng(0)
    none = np.array([3, 5, 2], np.int64)
    p = rnd.integers(0, 50, (40, 3))
    tid, g = np.nonzero(p)
    got = divergence.pair_sums(tid, g, p[tid, g], none)
    whole = np.where(p > 0, p, none)
    f = lambda a, b: (a - b) ** 2 // b
    want = [[sum(f(whole[:, s], whole[:, t])) - len(p) * f(none[s], none[t]) for t in range(3)] for s in range(3)]
    assert got.tolist() == [[int(x) for x in r] for r in want]
