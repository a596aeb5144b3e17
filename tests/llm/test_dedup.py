"""Line dedup, exact dedup and SimHash against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from churnlab.llm.common import with_ids
from churnlab.llm.exact_dedup import exact_dedup
from churnlab.llm.line_dedup import keep_bitmaps, line_dedup
from churnlab.llm.simhash import links, masks, simhash_components

from .frames import AWKWARD, frame, random_texts


def sha(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


# --- line dedup ---------------------------------------------------------

def brute_lines(rows, min_docs, min_chars=1, keep_first=False):
    docs = [(i, [(x, x.strip(" \t\n\r\x0b\x0c").encode().lower()) for x in (t or "").split("\n")]) for i, t in rows]
    often = Counter(k for _, ls in docs for k in {k for _, k in ls if len(k.decode()) >= min_chars})
    seen, out = set(), []
    for i, ls in docs:
        kept = []
        for x, k in ls:
            gone = often[k] >= min_docs
            if gone and keep_first and k not in seen:
                gone = False
                seen.add(k)
            kept += [] if gone else [x]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs,min_chars,keep_first", [(2, 1, False), (10, 1, False), (3, 5, False), (2, 1, True)])
def test_line_dedup(spark, min_docs, min_chars, keep_first):
    rows = [(i, t.replace(" ", "\n", i % 9)) for i, t in random_texts(150)]
    got = line_dedup(frame(spark, rows), min_docs=min_docs, min_chars=min_chars, keep_first=keep_first)
    assert sorted(map(tuple, got.collect()), key=str) == brute_lines(rows, min_docs, min_chars, keep_first)


def test_hot_line_over_many_partitions(spark):
    """A line of every document is split among range partitions and still dropped whole."""
    rows = [(i, f"own {i}\n Hot LINE \nown too {i // 3}") for i in range(2000)]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = line_dedup(frame(spark, rows), min_docs=10).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert all(r.n_dropped == 1 for r in got) and len(got) == 2000


def test_line_dedup_awkward(spark):
    got = line_dedup(frame(spark, AWKWARD), min_docs=2).collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(AWKWARD, 2)
    assert line_dedup(frame(spark, AWKWARD[:1]).where("doc_id < 0")).count() == 0


def test_bitmaps(spark):
    rows = [(i, f"a\nb{i}\nc") for i in range(12)]
    for r in keep_bitmaps(with_ids(frame(spark, rows)), 10).collect():
        assert np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bitmap), np.uint8))[:3].tolist() == [0, 1, 0]


# --- exact dedup --------------------------------------------------------

@pytest.mark.parametrize("rows", [random_texts(120), AWKWARD, []])
def test_exact_dedup(spark, rows):
    got = exact_dedup(frame(spark, rows) if rows else frame(spark, AWKWARD).limit(0)).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    key = lambda i: -1 if i is None else i
    want = []
    for t, ids in groups.items():
        keep = max(ids, key=key)
        for n, i in enumerate(ids):
            want.append((i, keep, len(ids), i == keep and i not in ids[:n], sha(t)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_exact_dedup_is_native(spark):
    from churnlab.llm.queries import op5_exact_dedup

    plan = op5_exact_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- SimHash ------------------------------------------------------------

def brute_fp(text, n):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("radius,shingle", [(2, 3), (4, 5)])
def test_simhash(spark, radius, shingle):
    rows = random_texts(120, seed=3)
    got = {r.doc_id: r for r in simhash_components(frame(spark, rows), shingle=shingle, radius=radius).collect()}
    fps = [brute_fp(t, shingle) for _, t in rows]
    roots = brute_components(fps, radius)
    assert [got[i].fingerprint for i, _ in rows] == [f"{x:016x}" for x in fps]
    assert [got[i].component_id for i, _ in rows] == roots


def test_simhash_awkward(spark):
    got = simhash_components(frame(spark, AWKWARD), shingle=3).collect()
    assert len(got) == len(AWKWARD)
    empty = [r for r in got if r.doc_id in (1, 2, 3)]
    assert {(r.fingerprint, r.component_id) for r in empty} == {("0" * 16, 1)}
    assert simhash_components(frame(spark, AWKWARD).limit(0)).count() == 0


@pytest.mark.parametrize("radius", [2, 4])
def test_masks_cover(radius):
    """Every set of up to ``radius`` positions is left out by some table."""
    rnd = np.random.default_rng(0)
    ms = masks(radius)
    for _ in range(3000):
        d = sum(1 << int(j) for j in rnd.choice(64, rnd.integers(1, radius + 1), replace=False))
        assert any(m & d == 0 for m in ms)


def test_links_against_all_pairs(spark):
    """Many fingerprints close to each other: a chain and a ball."""
    rnd = np.random.default_rng(1)
    base = int(rnd.integers(0, 1 << 62))
    fps = {base}
    x = base
    for k in range(40):
        x ^= 1 << int(rnd.integers(0, 64))
        x ^= 1 << int(rnd.integers(0, 64))
        fps |= {x, base ^ (1 << k), int(rnd.integers(0, 1 << 62))}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    got = links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2).collect()
    assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 2 for r in got)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for r in got:
        root[find(r.a)] = find(r.b)
    want = brute_components([f & ((1 << 64) - 1) for f in fps], 2)
    find_all = [find(f) for f in fps]
    assert len(set(zip(find_all, want))) == len(set(want)) == len(set(find_all))
