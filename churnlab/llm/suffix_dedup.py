"""Repeated byte strings by a depth-limited radix sort of suffixes.

A byte is removed if it lies in a ``width``-byte string that also starts earlier
(in an earlier document, or earlier in the same one). Only the first ``width``
bytes of a suffix matter, so suffixes are ordered by most-significant-digit
passes no deeper than that; each pass is one shuffle that brings equal digits
together and retires the suffixes whose digit nobody shares:

1. The first digit is chosen by content (see ``_anchors``): equal strings have
   equal anchors, and neighbouring suffixes share theirs, so a *run* of suffixes
   travels as one row (anchor hash, digest of all the run's bytes). Equal runs
   are settled here: all but the first are repeated. Of the others only those
   stay whose anchor also occurs in a different run.
2. The runs that stay are spread into their suffixes, and the digit is the whole
   ``width``-byte string: groups of equal strings are exactly the repeated ones,
   and all but the first in each are repeated.

Hashes are 128 bits in each pass. Every task first sorts what it has itself, so
a string or run that a third of the documents share leaves a task once for each
slice of text. An anchor that a task has seen in several runs is
known to be shared there and then: its runs are dealt by their digests, not by
the anchor, and one marker row tells the other tasks. Reducers stream over
sorted rows and hold one row back.

Null texts count as empty. Rows are ordered by id; where ids repeat, by ``with_ids``.

Repeated rows and rows with repeated or null ids are documents of their own in the
order of ``with_ids``, so of equal strings the first in that order stays. Texts of any
length are read whole; matches never cross documents. An empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm._anchors import MAX_BUFFER, runs
from churnlab.llm.common import restored, text_slices, utf8, with_ids, with_rest
from churnlab.session import cut_lineage

#: Kinds of rows, in the order in which a reducer needs them.
_MARK, _PLAIN, _SPLIT, _COVER = 0, 1, 2, 3
_ROWS = "kind int, a long, d long, _id long, s long, n long"
_NAMES = ["kind", "a", "d", "_id", "s", "n"]


def _batch(kind, a, d, i, s, n) -> pa.RecordBatch:
    long = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.broadcast_to(np.int32(kind), len(s)) if np.isscalar(kind) else kind), long(a), long(d), long(i),
         long(s), long(n)], _NAMES)


def _merged(i: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals [s, e) of each id, overlapping and adjacent ones joined."""
    if not len(s):
        return i, s, e
    o = np.lexsort((s, i))
    i, s, e = i[o], s[o], e[o]
    top = np.empty_like(e)
    own = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
    for a, b in zip(own.tolist(), [*own[1:].tolist(), len(i)]):
        top[a:b] = np.maximum.accumulate(e[a:b])
    new = np.concatenate(([True], (i[1:] != i[:-1]) | (s[1:] > top[:-1])))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(i) - 1)
    return i[new], s[new], top[last]


def _sorted_rows(a, d, i, s, n, width: int, by_anchor: bool) -> Iterator[pa.RecordBatch]:
    """What leaves a task: the first of each (a, d), the intervals of the others."""
    if not len(s):
        return
    o = np.lexsort((s, i, d, a))
    a, d, i, s, n = a[o], d[o], i[o], s[o], n[o]
    new_a = np.concatenate(([True], a[1:] != a[:-1]))
    first = new_a | np.concatenate(([True], d[1:] != d[:-1]))
    again = ~first
    ci, cs, ce = _merged(i[again], s[again], s[again] + n[again] + (width - 1))
    if len(ci):
        yield _batch(_COVER, ci, ci, ci, cs, ce - cs)
    if not by_anchor:
        yield _batch(_SPLIT, a[first], d[first], i[first], s[first], n[first])
        return
    group = np.cumsum(new_a) - 1
    several = np.bincount(group, weights=first) > 1
    kind = np.where(several[group], _SPLIT, _PLAIN).astype(np.int32)
    yield _batch(kind[first], a[first], d[first], i[first], s[first], n[first])
    mark = new_a & several[group]
    if mark.any():
        yield _batch(_MARK, a[mark], d[mark], i[mark], s[mark], n[mark])


def _run_rows(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                data, offsets = utf8(part)
                ids = np.asarray(part.column("_id"))
                raw = data.tobytes()
                a, d, i, s, n = [], [], [], [], []
                for j in np.flatnonzero(np.diff(offsets) >= width).tolist():
                    lo, hi = int(offsets[j]), int(offsets[j + 1])
                    for at in range(lo, hi - width + 1, MAX_BUFFER - width + 1):
                        anchor, start, count = runs(data[at:min(at + MAX_BUFFER, hi)], width, k)
                        start += at
                        ends = (start + count + (width - 1)).tolist()
                        d += [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(start.tolist(), ends)]
                        a.append(anchor)
                        s.append(start - lo)
                        n.append(count)
                        i.append(np.full(len(count), ids[j]))
                if a:
                    yield from _sorted_rows(np.concatenate(a), np.array(d, np.uint64), np.concatenate(i),
                                            np.concatenate(s), np.concatenate(n), width, True)
    return run


def _string_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                h, i, s = [], [], []
                for j, text, own in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist(),
                                        part.column("own").to_pylist()):
                    raw = text.encode()
                    at = np.concatenate([np.arange(x["s"], x["s"] + x["n"]) for x in own])
                    h += [xxhash.xxh3_128_digest(raw[x:x + width]) for x in at.tolist()]
                    s.append(at)
                    i.append(np.full(len(at), j, np.int64))
                if h:
                    pair = np.frombuffer(b"".join(h), np.int64).reshape(-1, 2)
                    at = np.concatenate(s)
                    yield from _sorted_rows(pair[:, 0], pair[:, 1], np.concatenate(i), at, np.ones_like(at), width, False)
    return run


def _settle(width: int):
    """Sorted rows of whole groups: (kind, _id, s, n). _COVER: an interval of n
    repeated bytes; _SPLIT: n suffixes that the next pass has to look at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, i, s, n) -> Iterator[pa.RecordBatch]:
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), kind, np.int32)), pa.array(i), pa.array(s), pa.array(n)],
                                                 ["kind", "_id", "s", "n"])

        last, shared, plain, held = (None, None, None), False, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, a, d, i, s, n = (np.asarray(batch.column(c)) for c in _NAMES)
            goes_on = last[0] == a[0]
            new_a = np.concatenate(([not goes_on], a[1:] != a[:-1]))
            new = new_a | np.concatenate(([(a[0], kind[0], d[0]) != last], (d[1:] != d[:-1]) | (kind[1:] != kind[:-1])))
            own = np.cumsum(np.concatenate(([True], new_a[1:]))) - 1  # 0: the batch's first anchor, which may go on
            first = new & (kind == _PLAIN)
            plains = np.bincount(own, weights=first)
            marked = np.bincount(own, weights=kind == _MARK) > 0
            if goes_on:
                plains[0] += plain
                marked[0] |= shared
            several = marked | (plains > 1)
            if held is not None and goes_on and several[0]:
                yield from out(_SPLIT, *held)
                held = None
            ask = (first & several[own]) | (new & (kind == _SPLIT))
            yield from out(_SPLIT, i[ask], s[ask], n[ask])
            again = ~new & ((kind == _PLAIN) | (kind == _SPLIT))
            yield from out(_COVER, i[again], s[again], n[again] + (width - 1))
            ready = kind == _COVER
            yield from out(_COVER, i[ready], s[ready], n[ready])
            if own[-1] or not goes_on:
                held = None
            if not several[-1]:
                wait = np.flatnonzero(first & (own == own[-1]))  # one row at most
                if len(wait):
                    held = (i[wait], s[wait], n[wait])
            last, shared, plain = (a[-1], kind[-1], d[-1]), bool(marked[-1]), int(plains[-1])
    return run


def _pass(rows: DataFrame, width: int, name: str) -> DataFrame:
    place = (F.when(F.col("kind") <= _PLAIN, F.xxhash64("a")).when(F.col("kind") == _SPLIT, F.xxhash64("a", "d"))
             .otherwise(F.xxhash64("_id", "s")))
    return cut_lineage(rows.repartition(place).sortWithinPartitions("a", "kind", "d", "_id", "s")
                       .mapInArrow(_settle(width), "kind int, _id long, s long, n long"), name)


def repeated_bytes(base: DataFrame, width: int = 100, k: int = 64) -> DataFrame:
    """(_id, s, n): intervals of repeated bytes, which may overlap. ``k``, a power
    of two below ``width``, is the length of anchors; it changes the work only."""
    if k & (k - 1) or not 0 < k < width < MAX_BUFFER // 2:
        raise ValueError("k must be a power of two below width")
    first = _pass(base.select("_id", "_text").mapInArrow(_run_rows(width, k), _ROWS), width, "suffix_runs")
    own = first.where(F.col("kind") == _SPLIT).groupBy("_id").agg(F.collect_list(F.struct("s", "n")).alias("own"))
    strings = base.select("_id", "_text").join(own, "_id").mapInArrow(_string_rows(width), _ROWS)
    second = _pass(strings, width, "suffix_strings")
    return (first.where(F.col("kind") == _COVER).unionByName(second.where(F.col("kind") == _COVER))
            .select("_id", "s", "n"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, spans = [], [], []
        for text, own in zip(batch.column("_text").to_pylist(), batch.column("own").to_pylist()):
            raw, s, e = _without(text, own)
            kept.append(raw)
            removed.append(int((e - s).sum()))
            spans.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_doc"), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(kept, pa.binary())], ["_id", "_doc", "n_removed", "spans", "kept_bytes"])


def _without(text: str, own: list[dict] | None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(bytes left, starts, ends of the maximal removed runs)."""
    raw = text.encode()
    s = np.array([x["s"] for x in own or []], np.int64)
    e = s + np.array([x["n"] for x in own or []], np.int64)
    _, s, e = _merged(np.zeros_like(s), s, e)
    at = [0, *np.stack((s, e), axis=1).ravel().tolist(), len(raw)]
    return b"".join(raw[x:y] for x, y in zip(at[::2], at[1::2])), s, e


def _intervals(base: DataFrame, width: int, k: int) -> DataFrame:
    return repeated_bytes(base, width, k).groupBy("_id").agg(F.collect_list(F.struct("s", "n")).alias("own"))


def cut_repeats(base: DataFrame, width: int = 100, k: int = 64) -> DataFrame:
    """Per document: _id, _doc, n_removed, ``spans`` (maximal removed runs of
    bytes) and ``kept_bytes`` (the others, which may not be valid UTF-8)."""
    kind = base.schema["_doc"].dataType.simpleString()
    return base.join(_intervals(base, width, k), "_id", "left").select("_id", "_doc", "_text", "own").mapInArrow(
        _cut, f"_id long, _doc {kind}, n_removed long, spans array<struct<start:long,end:long>>, kept_bytes binary")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 100) -> DataFrame:
    """One row per input row: the id, n_bytes, n_removed, spans, kept_bytes."""
    out = cut_repeats(with_ids(docs, id_col, text_col), width)
    return out.select(F.col("_doc").alias(id_col), (F.octet_length("kept_bytes") + F.col("n_removed")).alias("n_bytes"),
                      "n_removed", "spans", "kept_bytes")


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [_without(t, own)[0].decode("utf-8", "ignore")
                for t, own in zip(batch.column("_text").to_pylist(), batch.column("own").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(text, pa.string())], ["_id", "_new"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 100) -> DataFrame:
    """``docs`` with repeated strings cut out of the text; characters of which
    only a part is left go as well. All rows stay, texts without a repeat as they are."""
    base = with_rest(docs, id_col, text_col)
    own = _intervals(base.drop("_rest"), width, 64)
    cut = cut_lineage(base.select("_id", "_text").join(own, "_id").mapInArrow(_cut_texts, "_id long, _new string"), "cut_texts")
    rows = base.join(cut, "_id", "left").withColumn("_text", F.coalesce("_new", "_text")).drop("_new")
    return restored(rows, docs, id_col, text_col)
