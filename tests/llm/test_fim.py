"""Fill-in-middle against plain Python on code points, and an exact round trip."""

import hashlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlab.llm.fim import ExceptionIndex, check_sentinels, fill_in_middle, restored_text

from .frames import AWKWARD, frame, random_texts

ODD = ["aé日𝄞b" * 50, "𝄞", "é", "é", "a<P>b", "x<S>", "<M>", "<P", "<", "P><S", ">" * 20, "<P ><", "\x00\x01", "日" * 4000]


def plain(doc_id, text, seed=1):
    text = text or ""
    h = [int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("rows", [random_texts(200), AWKWARD, [(i, t) for i, t in enumerate(ODD * 12)], []])
def test_against_plain(spark, rows):
    docs = frame(spark, rows or AWKWARD)
    got = fill_in_middle(docs if rows else docs.limit(0)).withColumn("again", restored_text())
    assert sorted(map(str, (tuple(r[:6]) for r in got.collect()))) == sorted(str(plain(i, t)) for i, t in rows)
    joined = sorted(((str(r.doc_id), r.again) for r in got.collect()))
    assert joined == sorted((str(i), t or "") for i, t in rows)


def test_forms_and_other_sentinels(spark):
    """All three forms occur; sentinels, shares and the seed are parameters."""
    rows = [(i, f"täxt {i} <P> <S> <M> " * 3) for i in range(400)]
    marks = ("<|fim_p|>", "<|fim_s|>", "<|fim_m|>")
    got = fill_in_middle(frame(spark, rows), seed=7, plain_from=50, spm_below=50, sentinels=marks).withColumn("again", restored_text(sentinels=marks))
    assert got.where(F.col("again").isNull()).count() == 0 and {r.doc_id: r.again for r in got.collect()} == dict(rows)
    share = {r["form"]: r["count"] for r in got.groupBy("form").count().collect()}
    assert 150 < share["plain"] < 250 and 60 < share["psm"] < 140 and 60 < share["spm"] < 140


@pytest.mark.parametrize("marks", [("<P>", "P>", "<M>"), ("aba", "<S>", "<M>"), ("<a", "a<", "x"), ("", "a", "b")])
def test_sentinels_that_overlap(marks):
    with pytest.raises(ValueError):
        check_sentinels(marks)


@given(st.lists(st.text(max_size=40), max_size=6))
def test_index(texts):
    """Cuts at every code point of texts in a row, and back."""
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    index, text = ExceptionIndex(data), "".join(texts)
    want = [len(text[:k].encode()) for k in range(len(text) + 1)]
    assert index.bytes(np.arange(len(text) + 1)).tolist() == want
    assert index.points(np.array(want, np.int64)).tolist() == list(range(len(text) + 1))
    assert len(index.byte) == sum(c > "\x7f" for c in text)
