"""Line dedup: range-partitioned line hashes, streamed in order.

Each line's key is hashed (128 bits); a document contributes one row per
distinct key, with the positions of its lines. Rows are range-partitioned by
(hash, document) and sorted within partitions, with positions in order inside
the row. One pass streams over a partition's groups with at most
``min_docs - 1`` rows held back, and emits the lines to drop. A hot key spans
several partitions, because the document is part of the range key; its share in
each is decided there if it is large enough, or else settled by a small second
step over the rows held back at partition edges (fewer than ``2 * min_docs``
for each partition). What comes back per document is a compressed keep bitmap,
never text.

Null and empty texts have one empty line. Lines with a key shorter than
``min_chars`` are always kept. Every input row is a document of its own.

Repeated rows and rows with repeated or null ids are numbered by ``with_ids`` and
count one by one towards ``min_docs``; texts of any length are read whole; which of
equal lines comes first, where one is kept, goes by that numbering and the line's
place. An empty table gives an empty result; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import with_ids
from churnlab.session import cut_lineage

_LINES = "h1 long, h2 long, _id long, at array<int>"
_MARKS = "kind int, h1 long, h2 long, _id long, at array<int>, n long"
_DROP, _PENDING, _GROUP = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """The line with ASCII white space stripped at both ends, A-Z lower-cased
    (what these methods of ``bytes`` do)."""
    return line.strip().lower()


def _line_rows(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, ats = [], [], []
            for i, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
                at: dict[bytes, list[int]] = {}
                for k, line in enumerate(text.encode().split(b"\n")):
                    key = line_key(line)
                    if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        at.setdefault(xxhash.xxh3_128_digest(key), []).append(k)
                ids += [i] * len(at)
                hashes += at.keys()
                ats += at.values()
            h = np.frombuffer(b"".join(hashes), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64()),
                                              pa.array(ats, pa.list_(pa.int32()))], ["h1", "h2", "_id", "at"])
    return run


def _stream(min_docs: int):
    """Marks of the groups of equal (h1, h2), in sorted batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, least, held = None, 0, 0, []

        def mark(kind: int, rows: list[pa.RecordBatch], n: int = 0) -> Iterator[pa.RecordBatch]:
            for b in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, kind, np.int32)), *b.columns, pa.array(np.full(b.num_rows, n, np.int64))],
                    ["kind", "h1", "h2", "_id", "at", "n"])

        def close(edge: bool) -> Iterator[pa.RecordBatch]:
            """End of a group: what is held back matters only at the partition's edges."""
            if key is not None and (edge or count >= min_docs):
                yield from mark(_PENDING, held)
                one = pa.RecordBatch.from_arrays(
                    [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([least], pa.int64()),
                     pa.array([[]], pa.list_(pa.int32()))], ["h1", "h2", "_id", "at"])
                yield from mark(_GROUP, [one], count)

        edge = True
        for batch in batches:
            if not batch.num_rows:
                continue
            h = np.stack([np.asarray(batch.column(k)) for k in (0, 1)])
            starts = np.concatenate(([0], np.flatnonzero((h[:, 1:] != h[:, :-1]).any(axis=0)) + 1, [batch.num_rows]))
            sizes = np.diff(starts)
            # A small group that neither begins nor ends the batch is whole: all its lines stay.
            look = sizes >= min_docs
            look[[0, -1]] = True
            for g in np.flatnonzero(look).tolist():
                a, n = int(starts[g]), int(sizes[g])
                now = (int(h[0, a]), int(h[1, a]))
                if now != key:
                    yield from close(edge)
                    edge = key is None
                    key, count, held, least = now, 0, [], batch.column("_id")[a].as_py()
                count += n
                held.append(batch.slice(a, n))
                if count >= min_docs:
                    yield from mark(_DROP, held)
                    held = []
        yield from close(True)
    return run


def line_marks(base: DataFrame, min_docs: int, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(_id, at): positions of the lines to drop, some rows for each document.
    ``keep_first``: of each key the first line in (document, position) order stays."""
    rows = base.select("_id", "_text").mapInArrow(_line_rows(min_chars), _LINES)
    order = ["h1", "h2", "_id"]
    marks = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                        .mapInArrow(_stream(min_docs), _MARKS), "line_marks")
    often = (marks.where(F.col("kind") == _GROUP).groupBy("h1", "h2")
             .agg(F.sum("n").alias("n"), F.min("_id").alias("_id")).where(F.col("n") >= min_docs))
    late = marks.where(F.col("kind") == _PENDING).join(often.select("h1", "h2"), ["h1", "h2"], "left_semi")
    drops = marks.where(F.col("kind") == _DROP).unionByName(late).select("h1", "h2", "_id", "at")
    if keep_first:
        firsts = often.select("h1", "h2", "_id", F.lit(1).alias("_first"))
        drops = (drops.join(firsts, ["h1", "h2", "_id"], "left")
                 .withColumn("at", F.expr("if(_first is null, at, slice(at, 2, greatest(size(at) - 1, 0)))")))
    return drops.select("_id", "at")


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed, dropped = [], []
        for n, at in zip(batch.column("n_lines").to_pylist(), batch.column("at").to_pylist()):
            keep = np.ones(n, np.uint8)
            keep[np.array(at or [], np.int64)] = 0
            packed.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            dropped.append(n - int(keep.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("n_lines"), pa.array(dropped, pa.int64()), pa.array(packed, pa.binary())],
            ["_id", "n_lines", "n_dropped", "keep_bitmap"])


def keep_bitmaps(base: DataFrame, min_docs: int, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """Per document: _id, n_lines, n_dropped and ``keep_bitmap`` (zlib over one
    bit a line, first line in the highest bit, 1 = stays)."""
    marks = (line_marks(base, min_docs, min_chars, keep_first)
             .groupBy("_id").agg(F.flatten(F.collect_list("at")).alias("at")))
    lines = (F.length("_text") - F.length(F.translate("_text", "\n", "")) + 1).cast("long")
    return (base.select("_id", lines.alias("n_lines")).join(marks, "_id", "left")
            .mapInArrow(_bitmaps, "_id long, n_lines long, n_dropped long, keep_bitmap binary"))


def _kept_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for text, n, bits in zip(batch.column("_text").to_pylist(), batch.column("n_dropped").to_pylist(),
                                 batch.column("keep_bitmap").to_pylist()):
            if n:
                keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8))
                text = "\n".join(x for x, k in zip(text.split("\n"), keep.tolist()) if k)
            kept.append(text)
        i = batch.schema.get_field_index("_text")
        yield batch.set_column(i, "_text", pa.array(kept, pa.string())).drop_columns(["keep_bitmap"])


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
               min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """One row per input row: the id, n_lines, n_dropped, kept_text (the lines
    that stay, joined by a line feed; empty if none stays)."""
    base = with_ids(docs, id_col, text_col)
    bitmaps = keep_bitmaps(base, min_docs, min_chars, keep_first)
    out = base.join(bitmaps, "_id").mapInArrow(
        _kept_texts, f"_id long, _doc {base.schema['_doc'].dataType.simpleString()}, _text string, n_lines long, n_dropped long")
    return out.select(F.col("_doc").alias(id_col), "n_lines", "n_dropped", F.col("_text").alias("kept_text"))
