"""SentencePiece encoding against the library, and an exact round trip."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from churnlab.llm.sp_lattice import Vocabulary, lattice_lexicon, sp_decode, sp_encode, spelled, vocabulary, words

from .frames import AWKWARD, frame, random_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def encode(text):
    v = vocabulary(PATH)
    return [i for w in map(spelled, words(text)) for i in v.ids(w, v.fold(w))]


def odd_texts(seed, n=2000):
    rnd = random.Random(seed)
    pieces = list(vocabulary(PATH).id)
    out = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 8))).replace("▁", " ") for _ in range(n)]
    out += ["".join(rnd.choice("etaoinshr \n  dlu") for _ in range(rnd.randint(1, 40))) for _ in range(n)]
    out += ["".join(chr(rnd.choice([rnd.randint(1, 0x250), rnd.randint(0x3000, 0x9000), 0x1F600, 0x20, 0xA0, 0x200B]))
                    for _ in range(rnd.randint(1, 30))) for _ in range(n)]
    return out + [" " * k for k in range(70)] + ["x" + " " * k + "y" for k in range(70)] + ["", "a" * 1000, "ab" * 300, "\n", "a \nb", " \n", "x\n y", "▁", "a▁b ▁c"]


def test_fold_is_the_library():
    for t in odd_texts(1):
        assert encode(t) == MODEL.encode(t), ascii(t)


def test_merging_is_the_fold():
    v = vocabulary(PATH)
    for w in {w for t in odd_texts(4) for w in map(spelled, words(t)) if "▁▁" not in w and len(w) <= 62}:
        assert v.merged(w) == v.ids(w, v.fold(w))


@pytest.mark.parametrize("lexicon", [0, 40, 200_000])
def test_encode_and_decode(spark, lexicon):
    rows = list(enumerate(odd_texts(2, 150) + [t for _, t in random_texts(80)]))
    got = sp_encode(frame(spark, rows), PATH, lexicon_words=lexicon, columns=("ids", "decoded", "n_ids", "ids_crc32", "decoded_sha256")).collect()
    assert {r.doc_id: list(r.ids) for r in got} == {i: MODEL.encode(t) for i, t in rows}
    for r in got:
        assert r.n_ids == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert {r.doc_id: r.decoded for r in got} == {i: t.replace("▁", " ") for i, t in rows}


def test_relation_is_the_fold(spark):
    v = Vocabulary(PATH)
    found = sorted({w for t in odd_texts(3, 500) for w in map(spelled, words(t)) if len(w) <= 62 and "▁" not in w[1:]})
    got = {r.word: r["mask"] for r in lattice_lexicon(spark.createDataFrame([(w,) for w in found], "word string"), PATH).collect()}
    # words without a single edge keep all boundaries and are not listed
    assert all(got.get(w, (2 << len(w)) - 1) == v.fold(w) for w in found) and len(got) > len(found) / 2


def test_awkward(spark):
    got = sp_encode(frame(spark, AWKWARD), PATH, columns=("decoded",))
    assert sorted(((r.doc_id, r.decoded) for r in got.collect()), key=str) == sorted(((i, t or "") for i, t in AWKWARD), key=str)
    assert sp_encode(frame(spark, AWKWARD).limit(0), PATH).count() == 0


def test_columns(spark):
    df = spark.createDataFrame([(MODEL.encode("hello  world"),), (None,), ([],)], "ids array<int>")
    assert [r.text for r in sp_decode(df, PATH).collect()] == ["hello  world", None, ""]
