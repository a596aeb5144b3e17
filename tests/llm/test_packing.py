"""Packing: ids against the tokenizer library, an exact round trip, few sequences."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from churnlab.llm.packing import best_fit_packing, pack, pack_pieces, sequences, sum_of_squares

from .frames import AWKWARD, frame, random_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def want_ids(rows, capacity):
    t = Tokenizer.from_file(PATH)
    out = {}
    for n, (i, text) in enumerate(rows):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        out[n] = (i, [(a, ids[a:b]) for a, b in zip(cuts, cuts[1:])])
    return out


@pytest.mark.parametrize("rows,capacity", [(random_texts(150, 4), 64), (AWKWARD, 1024),
                                           ([(1, "<|endoftext|> x  \n\n y's 'll 12345"), (2, "日本語 ü " * 500)], 16)])
def test_round_trip(spark, rows, capacity):
    packed = best_fit_packing(frame(spark, rows), PATH, capacity=capacity, keep_ids=True)
    got = packed.collect()
    want = sorted((i, k, a, ids) for i, p in want_ids(rows, capacity).values() for k, (a, ids) in enumerate(p) if i is not None)
    assert sorted((r.doc_id, r.piece, r.start, list(r.ids)) for r in got if r.doc_id is not None) == want
    assert sum(len(p) for _, p in want_ids(rows, capacity).values()) == len(got)
    seqs = defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
        seqs[r.sequence_id].append((r.offset, list(r.ids)))
    whole = {r.sequence_id: list(r.ids) for r in sequences(packed).collect()}
    for k, parts in seqs.items():
        parts.sort()
        assert [p[0] for p in parts] == [sum(len(x[1]) for x in parts[:j]) for j in range(len(parts))]
        assert whole[k] == [t for _, x in parts for t in x] and len(whole[k]) <= capacity


def test_empty(spark):
    assert best_fit_packing(frame(spark, AWKWARD).limit(0), PATH).count() == 0


def test_few_sequences():
    rnd = np.random.default_rng(0)
    lengths = np.minimum(rnd.geometric(1 / 300, 20_000), 1024).astype(np.int64)
    place, offset = pack(lengths, 1024)
    used = np.bincount(place, weights=lengths)
    assert used.max() <= 1024 and len(used) <= 1.005 * lengths.sum() / 1024
    o = np.lexsort((offset, place))
    assert all((offset[o][1:] == np.where(place[o][1:] == place[o][:-1], offset[o][:-1] + lengths[o][:-1], 0)))


def test_sum_of_squares_choice():
    """Each placement has the least sum of squares, by trying all."""
    rnd = np.random.default_rng(1)
    lengths = np.sort(rnd.integers(1, 21, 120))[::-1].copy()
    place, _ = sum_of_squares(lengths, 20)
    gaps: dict[int, int] = {}
    for s, p in zip(lengths.tolist(), place.tolist()):
        def cost(b, g):
            now = {**gaps, b: g - s}
            return sum(n * n for n in np.bincount([x for x in now.values() if x] or [0], minlength=21)[1:].tolist())
        options = [cost(-1, 20)] + [cost(b, g) for b, g in gaps.items() if g >= s]
        assert cost(p, gaps.get(p, 20)) == min(options)
        gaps[p] = gaps.get(p, 20) - s


def test_shards(spark):
    cut = spark.range(3000).selectExpr("id as _id", "0 as piece", "id % 1024 + 1 as length")
    got = pack_pieces(cut, 1024, shard_pieces=500).collect()
    assert len(got) == 3000 and len({r.sequence_id >> 32 for r in got}) == 6


def test_whole_table_ids(spark):
    """The fast encoder gives the library's ids on every test document."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = best_fit_packing(frame(spark, rows), PATH, keep_ids=True).collect()
    want = sorted((i, k, ids) for i, p in want_ids(rows, 1024).values() for k, (_, ids) in enumerate(p))
    assert sorted((r.doc_id, r.piece, list(r.ids)) for r in got) == want


def test_added_tokens(spark):
    """The file's added token, spelled out in a text, has the id the library gives it."""
    t = Tokenizer.from_file(PATH)
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, "x\n\n <|endoftext|>  y 12<|endoftext|>'s"),
            (4, "<|endoftext| > <|ENDOFTEXT|> <|endoftext"), (5, "é<|endoftext|>日本 " * 300)]
    got = best_fit_packing(frame(spark, rows), PATH, keep_ids=True).orderBy("doc_id", "piece").collect()
    for i, text in rows:
        ids = [x for r in got if r.doc_id == i for x in r.ids]
        assert ids == [*t.encode(text, add_special_tokens=False).ids, 2]
    assert [x for r in got if r.doc_id == 1 for x in r.ids] == [64, 220, 50256, 275, 2]
