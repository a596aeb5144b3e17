"""Sum-of-squares packing of token sequences.

Documents are tokenised, ended with an end id and cut into pieces of at most
``capacity`` tokens (the first piece takes the remainder). Full pieces are
sequences of their own. The others are dealt at random into shards of a bounded
number of pieces, and each shard is packed alone: in order of falling length,
a piece goes to the open sequence, or to a new one, after which the sum over all
gaps g of N(g)^2 is smallest, N(g) being the number of open sequences with g
tokens left (ties: the smallest gap; a new one last). That choice keeps gaps of
many sizes in store, but leaves some sequences open at the end; the pieces of
those are placed once more, each in the smallest gap that holds it. A shard is
large against the few sequences it leaves open.

A null text is empty: one piece with the end id only. Every input row is a
document of its own.

Repeated rows and rows with repeated or null ids are numbered by ``with_ids``; a text
of any length is cut into as many pieces as it needs. Pieces of one length are placed in
the order of that numbering. An empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import text_slices, with_ids
from churnlab.session import cut_lineage

#: Pieces in a shard, on average.
SHARD_PIECES = 100_000


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies:
    itself where Latin-1 prints it, else the next free one from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    """An encoder with the ids of the byte-level BPE file ``path`` (``tokenizers``
    JSON): its vocabulary as merge ranks, which its ids are. The file's added tokens
    are found in a text first, as ``tokenizers`` does, and have their own ids."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = byte_characters()
    added = spec.get("added_tokens", ())
    if odd := [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"]]:
        raise ValueError(f"added tokens that take in or need their surroundings: {odd}")
    special = {t["content"]: t["id"] for t in added}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _piece_rows(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(path)
        for batch in batches:
            for part in text_slices(batch):
                rows, tokens = [], []
                for i, text in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist()):
                    ids = np.append(encoder.encode_to_numpy(text, allowed_special="all"), end_id).astype("<u4")
                    at = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(at, at[1:])):
                        rows.append((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                        tokens.append(ids[a:b].view("<i4") if keep_ids else None)
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                names = ["_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    cols, names = [*cols, pa.array(tokens, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def pieces(base: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """(_id, piece, start, length, ids_crc32[, ids]), written out: texts are
    tokenised once."""
    schema = "_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return cut_lineage(base.select("_id", "_text").mapInArrow(_piece_rows(path, capacity, end_id, keep_ids), schema), "pieces")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, tokens left in it at the end) of each piece; lengths 1..capacity."""
    count = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    left: list[int] = []
    place = np.empty(len(lengths), np.int64)
    far = np.int64(1) << 40
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        new = 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        g = capacity
        if s < capacity:
            # Sequences with gap s..capacity-1: one fewer there, one more at gap - s (full ones don't count).
            fewer = count[s:capacity]
            more = 2 * count[: capacity - s] + 1
            more[0] = 0
            cost = np.where(fewer > 0, 1 - 2 * fewer + more, far)
            k = int(cost.argmin())
            if cost[k] <= new:
                g = s + k
        if g == capacity:
            place[i] = len(left)
            left.append(capacity)
        else:
            place[i] = open_at[g].pop()
            count[g] -= 1
        left[place[i]] = g - s
        if g > s:
            count[g - s] += 1
            open_at[g - s].append(int(place[i]))
    return place, np.array(left, np.int64)[place] if len(left) else place


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each piece: in falling order, each in the smallest gap that holds it."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    place, n = np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        fits = count[s:] > 0
        k = int(fits.argmax())
        if fits[k]:
            g = s + k
            place[i] = open_at[g].pop()
            count[g] -= 1
        else:
            g, place[i], n = capacity, n, n + 1
        if g > s:
            count[g - s] += 1
            open_at[g - s].append(int(place[i]))
    return place


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset in it) of each piece of one shard."""
    place, left = sum_of_squares(lengths, capacity)
    rest = left > 0
    place[rest] = best_fit(lengths[rest], capacity) + len(lengths)
    _, place = np.unique(place, return_inverse=True)
    order = np.argsort(place, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    begin = np.concatenate(([True], place[order][1:] != place[order][:-1])) if len(order) else np.zeros(0, bool)
    offset = np.empty(len(lengths), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(begin, before, 0)) if len(order) else before
    return place, offset


def _pack_shard(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # The same order whatever the shuffle delivers, so that a task run anew gives the same sequences.
        rows = rows.sort_values(["_id", "piece"], ignore_index=True)
        place, offset = pack(rows["length"].to_numpy(np.int64), capacity)
        return pd.DataFrame({"_id": rows["_id"], "piece": rows["piece"],
                             "sequence_id": rows["shard"].to_numpy(np.int64) * (1 << 32) + place, "offset": offset})
    return run


def pack_pieces(cut: DataFrame, capacity: int = 1024, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(_id, piece, sequence_id, offset) of pieces (_id, piece, length)."""
    shards = -(-cut.count() // shard_pieces) or 1
    dealt = cut.select("_id", "piece", "length", F.pmod(F.xxhash64("_id", "piece"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(_pack_shard(capacity), "_id long, piece int, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
                     end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32, sequence_id,
    offset, and with ``keep_ids`` the piece's token ids."""
    base = with_ids(docs, id_col, text_col)
    cut = pieces(base, path, capacity, end_id, keep_ids)
    out = cut.join(pack_pieces(cut, capacity), ["_id", "piece"])
    if base.where(~F.col("_id").eqNullSafe(F.col("_doc"))).isEmpty():
        out = out.withColumn("_doc", F.col("_id").cast(base.schema["_doc"].dataType))
    else:
        out = out.join(base.select("_id", "_doc"), "_id")
    names = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return out.select(F.col("_doc").alias(id_col), *names)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from ``keep_ids`` rows.
    A group has at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
