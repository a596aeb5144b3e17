"""Token files: the library's ids, exact round trips, damage noticed, blocks read alone."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnlab.llm import token_rans
from churnlab.llm.common import with_ids
from churnlab.llm.token_rans import Frame, WordIds, frame as make_frame, read_tokens, scaled, token_files, token_round_trip

from .frames import AWKWARD, frame, random_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["a <|endoftext|>b <|startoftext|>", "x\x1cy\x0bz\x0cw", "don't WE'LL 's 'S\n\n't", "é ́x ﬁ Å", "a b c\u0085d", "ΣΑΣ İx ǅ",
       "日本語 テスト", "1234 5 6.7 !!??", "<|endof text|>", "​ ﻿ x", "👩‍👩‍👧 ok"]


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def want(ordered):
    out, at = [], 0
    for i, t in ordered:
        ids = ids_of(t)
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("rows", [random_texts(150, 4), [(7 * i - 20, t) for i, t in enumerate(ODD)]])
def test_round_trip(spark, rows):
    got = token_round_trip(frame(spark, rows), PATH).collect()
    assert sorted(map(tuple, got)) == want(sorted(rows))


def test_awkward(spark):
    """Null and repeated ids are documents of their own, in the order of ``with_ids``."""
    got = token_round_trip(frame(spark, AWKWARD), PATH).orderBy("start").collect()
    ordered = [(r._doc, r._text) for r in with_ids(frame(spark, AWKWARD)).orderBy("_id").collect()]
    assert [tuple(r) for r in got] == want(ordered)
    assert token_round_trip(frame(spark, AWKWARD).limit(0), PATH).count() == 0


def test_many_files(spark, monkeypatch, tmp_path):
    """Files and frames in order of the ids; the ids themselves come back."""
    monkeypatch.setattr(token_rans, "FILE_TOKENS", 500)
    rows = random_texts(200, 6)
    got = token_files(frame(spark, rows), f"file://{tmp_path}/t", PATH).collect()
    assert sorted(map(tuple, got)) == want(rows)
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/t/ids/part-*").where("length > 0").orderBy("path").collect()
    assert len(files) > 5 and all(f.content[:8] == token_rans.MAGIC for f in files)
    table = token_rans.read_table(spark, f"file://{tmp_path}/t")
    keys = [k for f in files for k in Frame(memoryview(f.content), 0, table).index[:, 0].tolist()]
    assert keys == sorted(keys) == [i for i, _ in rows]
    back = read_tokens(spark, f"file://{tmp_path}/t", keep_ids=True).collect()
    assert {r._id: list(r.ids) for r in back} == {i: ids_of(t).tolist() for i, t in rows}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30), max_size=5))
def test_words_as_the_library(texts):
    words = WordIds(PATH)
    assert words.direct
    assert [np.frombuffer(words.of(t.encode()), "<u2").tolist() for t in texts] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_plain_character():
    """Each character and pair that the direct way takes, as the library has it."""
    words = WordIds(PATH)
    chars = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x100), 0x131, 0x17F, 0x1C5, 0x300, 0x345, 0x3C2, 0x1E9E, 0x212B)]
    texts = [f"{a}{b}{c}" for a in chars for b in "aéZ7'." for c in ("", "s", "!")]
    assert [np.frombuffer(words.of(t.encode()), "<u2").tolist() for t in texts] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(token_rans, "KEPT_WORDS", 5)
    words = WordIds(PATH)
    for k in range(9):
        text = " ".join(f"word{j}x" for j in range(k, k + 4)) + " " + "y" * 200
        assert np.frombuffer(words.of(text.encode()), "<u2").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        assert len(words) <= 5 and len(words.old) <= 5 and all(len(w) <= 64 for w in words)


def coded(n, seed=0, most=3000):
    rnd = np.random.default_rng(seed)
    ids = (rnd.zipf(1.3, n) % most).astype("<u4")
    used, count = np.unique(ids, return_counts=True)
    return ids, scaled(used.tolist(), count.tolist())


@pytest.mark.parametrize("n", [1, 31, 32, 33, 8191, 8192, 8193, 300_000])
def test_frame_sizes(n):
    ids, table = coded(n, n)
    assert table.freq.sum() == 1 << int(table.bits) and table.freq[np.unique(ids)].min() >= 1
    docs = list(enumerate(np.array_split(ids, min(n, 70))))
    raw = b"\n" + make_frame(table, docs)
    got = Frame(memoryview(raw), 1, table)
    assert [(k, x.tolist()) for k, x in got.documents()] == [(k, x.tolist()) for k, x in docs]
    for a, b in ((0, n), (n // 3, n // 2), (n - 1, n), (n // 2, n // 2), (min(n, 8191), min(n, 8193))):
        assert got.read_range(a, b).tolist() == ids[a:b].tolist()


def test_size_is_near_the_entropy():
    ids, table = coded(200_000)
    p = np.bincount(ids)[np.unique(ids)] / len(ids)
    assert len(make_frame(table, [(0, ids)])) * 8 / len(ids) < 1.06 * -(p * np.log2(p)).sum()


def test_a_block_is_read_alone():
    """Damage to one block's words leaves the others readable, and is noticed there."""
    ids, table = coded(50_000)
    one = Frame(memoryview(make_frame(table, [(0, ids)])), 0, table)
    one.words = one.words.copy()
    one.words[int(one.first[2]) + 5] ^= 1 << 7
    assert one.read_range(0, 2 * 8192).tolist() == ids[: 2 * 8192].tolist()
    assert one.read_range(3 * 8192, 50_000).tolist() == ids[3 * 8192:].tolist()
    with pytest.raises(ValueError):
        one.read_range(2 * 8192, 2 * 8192 + 10)


def test_damaged_frames():
    ids, table = coded(5000)
    raw = make_frame(table, [(0, ids)])
    other = coded(5000, 9)[1]
    broken = bytearray(raw)
    broken[-3] ^= 1
    for bad, t in ((bytes(broken), table), (raw[:-1], table), (b"x" + raw[1:], table), (raw, other)):
        with pytest.raises(ValueError):
            Frame(memoryview(bad), 0, t)


def test_one_long_document_among_many(spark):
    """A document of several frames' ids stays whole."""
    rows = [(i, "short one") for i in range(50)] + [(25_000, "lorem ipsum dolor sit amet " * 60_000)] + [(30_000 + i, None) for i in range(5)]
    got = token_round_trip(frame(spark, rows), PATH)
    assert sorted(map(tuple, got.collect())) == want(rows)
    assert got.agg(F.max("n_tokens")).first()[0] > token_rans.FRAME_TOKENS
