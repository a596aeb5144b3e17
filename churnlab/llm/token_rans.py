"""Token ids as files, entropy-coded by a static range asymmetric numeral system.

Texts are tokenised with the ``tokenizers`` library and ended with an end id. All
ids are counted, and the counts scaled to one table of frequencies that every
block shares. Documents go to files in ascending order; a file is a chain of
frames.

A frame holds whole documents, at least ``FRAME_TOKENS`` ids of them (the last
frame of a task may hold fewer), cut into blocks of ``BLOCK_TOKENS`` ids. A block
is coded on its own by ``LANES`` interleaved states: id j of the block belongs to
lane j mod LANES, and the lanes read 32-bit words from one stream in turn. The
frame's directory is a list of checkpoints, one for each block: where its words
begin, the lanes' first states, and a CRC-32 of its ids. With a checkpoint a
block is read without any other, so a frame decodes all its blocks side by side
in one vector, and ``read_range`` only the blocks that it needs.

Layout of a frame (little endian): the magic ``RANSFRM1``; 64-bit length of the
whole frame, number of documents, number of ids; 32-bit CRC of the frequency
table, CRC of the rest; then, as zlib streams with a 64-bit length each, the
documents (key, number of ids) and the directory (first word, states, CRC); then
the words. Frames are closed with one line feed, which belongs to the chain.
The frequency table is a Parquet table beside the files.

A null text counts as empty: the end id alone. Every input row is a document of
its own, numbered by ``with_ids`` (which settles repeated rows and repeated or
null ids). A text of any length is one document of one frame. An empty table
gives files without frames. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.running import running_totals
from churnlab.llm.common import prepare, text_slices, with_ids
from churnlab.llm.packing import byte_characters
from churnlab.session import cut_lineage, scratch_path, shuffle_cleanup

MAGIC = b"RANSFRM1"
FRAME_TOKENS, BLOCK_TOKENS, LANES = 1 << 18, 8192, 32
#: Frames in a file, at most, and ids in a file, on average.
FILE_FRAMES, FILE_TOKENS = 64, 4_000_000
#: Distinct words in each of the two generations that a worker keeps, and the longest word kept (bytes).
KEPT_WORDS, KEPT_BYTES = 500_000, 64
# A public file's normalizer and pre-tokenizer, to tell whether the direct way holds.
_NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                                               {"type": "Lowercase"}]}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words that ``_NORMAL`` leaves as they are and ``_SPLIT`` cuts like ``_PIECE`` (no apostrophe).
_PLAIN = re.compile(r"[!-&(-@\[-~ß-öø-ÿ]+")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_HEAD = struct.Struct("<8sQQQII")
_LOW = np.uint64(1 << 31)


# ------------------------------------------------------------------ tokens
@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds(dict):
    """Ids of words (bytes without ASCII white space) by the ``tokenizers`` file ``path``.

    Words are kept in two generations of at most ``KEPT_WORDS``: a full one becomes
    the old one, and words that are met again move on. Others are encoded by the
    library. Where the file has the lower-casing, letter-run pre-tokenizer of
    ``_NORMAL`` and ``_SPLIT``, a word of lower-case Latin letters, digits and signs is cut by
    that rule here, and its pieces go to the library's model at once; any other word
    goes through the whole library.
    """

    def __init__(self, path: str):
        super().__init__()
        self.library, self.model, self.old = _library(path), _library(path).model, {}
        spec = json.loads(self.library.to_str())
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.direct = (spec["normalizer"] == _NORMAL and len(pre) == 2 and spec["model"]["type"] == "BPE" and not spec["model"]["dropout"]
                       and pre[0] == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
                       and pre[1]["type"] == "ByteLevel" and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"])
        self.marks = [t["content"].encode().lower() if self.direct else t["content"].encode() for t in spec["added_tokens"]]
        self.byte = {b: c for c, b in byte_characters().items()}
        self.kind = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.kind).itemsize
        #: Signs that stand alone after letters, with their ids.
        self.signs = {c.encode(): array(self.kind, self.whole(c)).tobytes() for c in ".,;:!?)" if self.direct}

    def __missing__(self, word: bytes) -> bytes:
        got = self.old.get(word)
        if got is None and word[-1:] in self.signs and word[:-1].isalpha():
            got = self[word[:-1]] + self.signs[word[-1:]]
        if got is None:
            got = array(self.kind, self._encoded(word)).tobytes()
        if len(word) <= KEPT_BYTES:
            if len(self) >= KEPT_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = got
        return got

    def _encoded(self, word: bytes) -> list[int]:
        text, short = word.decode(), self.direct and len(word) <= KEPT_BYTES
        if short and word.islower() and word.isalpha():  # of bytes: a-z
            return [t.id for t in self.model.tokenize(text)]
        if short and _PLAIN.fullmatch(text):
            pieces = _PIECE.findall(text)
            if not text.isascii():
                pieces = ["".join([self.byte[b] for b in p.encode()]) for p in pieces]
            return [t.id for p in pieces for t in self.model.tokenize(p)]
        return self.whole(text)

    def whole(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def of(self, text: bytes) -> bytes:
        """Ids of a text: its words' ids in a row, since the pre-tokenizer drops white space."""
        low = text.lower() if self.direct else text  # of bytes: A-Z
        for mark in self.marks:
            if mark in low:  # added tokens count as they are spelled, wherever they stand
                return array(self.kind, self.whole(text.decode())).tobytes()
        return b"".join(map(self.__getitem__, low.split()))  # of bytes: at ASCII white space


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """Kept by the worker from task to task."""
    return WordIds(path)


def splits_at_space(path: str) -> bool:
    """Whether the file's pre-tokenizer drops white space, as ``WordIds`` needs, and
    no added token holds any."""
    t = _library(path)
    if any(c.isspace() for x in t.get_added_tokens_decoder().values() for c in x.content):
        return False
    pieces = t.pre_tokenizer.pre_tokenize_str("a b\tc\nd  e") if t.pre_tokenizer else [("a b", (0, 3))]
    return all(not any(c in " \t\nĠĊĉ" for c in p) for p, _ in pieces)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        end, pack = array(words.kind, [end_id]).tobytes(), zstandard.ZstdCompressor(level=1)
        by_word = splits_at_space(path)
        for batch in batches:
            for part in text_slices(batch, limit=1 << 20):
                texts = part.column("_text").cast(pa.large_binary()).to_pylist()
                if by_word:
                    ids = [words.of(t) + end for t in texts]
                else:
                    ids = [array(words.kind, words.whole(t.decode())).tobytes() + end for t in texts]
                n = [len(x) // words.width for x in ids]
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(n, pa.int64()), pa.array(map(pack.compress, ids), pa.binary())],
                                                 ["_id", "n", "ids"])
    return run


def _unpacked(n: int, ids: bytes) -> np.ndarray:
    raw = zstandard.decompress(ids)
    return np.frombuffer(raw, f"<u{len(raw) // n}")


def tokenised(base: DataFrame, path: str, end_id: int) -> DataFrame:
    """(_id, n, ids) of ``with_ids`` rows, the ids compressed, written out: texts are
    tokenised once."""
    return cut_lineage(base.select("_id", "_text").mapInArrow(_encode(path, end_id), "_id long, n long, ids binary"), "tokens")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(0, np.int64)
    for batch in batches:
        for part in text_slices(batch, "ids", 1 << 20):
            got = np.bincount(np.concatenate(list(map(_unpacked, part.column("n").to_pylist(), part.column("ids").to_pylist()))))
            if len(got) > len(count):
                count, got = got, count
            count[: len(got)] += got
    used = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(count[used], pa.int64())], ["id", "n"])


# ------------------------------------------------------------------- coder
class Table:
    """Frequencies of ids, which sum to 2^bits, and the coder on them."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, bits: int):
        self.bits, self.ids = np.uint64(bits), ids.astype("<u4")
        start = np.cumsum(freq) - freq
        size = int(ids.max()) + 1 if len(ids) else 0
        self.freq, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[ids], self.start[ids] = freq, start
        self.slot = np.repeat(self.ids, freq.astype(np.int64))
        #: For the decoder, by slot: the id's frequency, the place of the slot among the id's.
        self.slot_freq = self.freq[self.slot]
        self.slot_place = np.arange(len(self.slot), dtype=np.uint64) - self.start[self.slot]
        self.crc = zlib.crc32(self.ids.tobytes() + freq.astype("<u8").tobytes() + bytes([bits]))

    def encode(self, ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """(words of each block, first states [block, lane]) of ids."""
        n = len(ids)
        blocks, steps = -(-n // BLOCK_TOKENS), BLOCK_TOKENS // LANES
        # A symbol of the whole range's frequency changes no state: it fills the last block.
        freq = np.full(blocks * BLOCK_TOKENS, np.uint64(1) << self.bits)
        start = np.zeros(len(freq), np.uint64)
        freq[:n], start[:n] = self.freq[ids], self.start[ids]
        by_step = lambda x: np.ascontiguousarray(x.reshape(blocks, steps, LANES).transpose(1, 0, 2)).reshape(steps, -1)
        freq, start = by_step(freq), by_step(start)
        limit, grow = freq << (np.uint64(63) - self.bits), (np.uint64(1) << self.bits) - freq
        state = np.full(blocks * LANES, _LOW)
        words, lane = [], []
        for k in range(steps - 1, -1, -1):
            out = np.flatnonzero(state >= limit[k])
            given = state[out]
            words.append(given.astype("<u4"))
            lane.append(out)
            state[out] = given >> np.uint64(32)
            state += state // freq[k] * grow[k] + start[k]
        # Step by step, lane by lane: the order in which the decoder reads them.
        owner, words = np.concatenate(lane[::-1]) // LANES, np.concatenate(words[::-1])
        words = words[np.argsort(owner, kind="stable")]
        return np.split(words, np.cumsum(np.bincount(owner, minlength=blocks))[:-1]), state.reshape(blocks, LANES)

    def decode(self, words: np.ndarray, first: np.ndarray, state: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of blocks, whose words begin at ``first`` of ``words``."""
        blocks = len(sizes)
        steps = -(-int(sizes.max(initial=0)) // LANES)
        out = np.zeros((steps, blocks, LANES), "<u4")
        at, state = first.astype(np.int64)[:, None] - 1, state.copy()
        lane, mask = np.arange(LANES), np.uint64((1 << int(self.bits)) - 1)
        words = np.append(words, np.zeros(1, "<u4")).astype(np.uint64)
        # Up to here all blocks take every lane: all but a frame's last are equally long.
        full = int(sizes.min(initial=BLOCK_TOKENS)) // LANES
        for k in range(steps):
            low = state & mask
            out[k] = self.slot[low]
            then = self.slot_freq[low] * (state >> self.bits) + self.slot_place[low]
            if k >= full:
                then = np.where(k * LANES + lane < sizes[:, None], then, state)
            # A lane that has ended stands at ``_LOW`` and needs no word.
            need = then < _LOW
            turn = need.cumsum(axis=1)
            read = words.take(at + turn, mode="clip")
            state = np.where(need, (then << np.uint64(32)) | read, then)
            at = at + turn[:, -1:]
        flat = out.transpose(1, 0, 2).reshape(blocks, -1)
        if (state[:] != _LOW).any():
            raise ValueError("a block's states do not end where they began")
        return np.concatenate([flat[b, : sizes[b]] for b in range(blocks)]) if blocks else np.zeros(0, "<u4")


def scaled(ids: list[int], counts: list[int]) -> Table:
    """The table of counts: every id that occurs gets at least 1, the rest goes by
    share (floors, then the largest remainders; ties to the smaller id)."""
    bits = max(16, (4 * len(ids)).bit_length())
    spare, total = (1 << bits) - len(ids), sum(counts)
    floors = [c * spare // total for c in counts]
    rest = [c * spare % total for c in counts]
    freq = np.array(floors, np.int64) + 1
    for k in sorted(range(len(ids)), key=lambda k: (-rest[k], ids[k]))[: spare - sum(floors)]:
        freq[k] += 1
    return Table(np.array(ids, np.int64), freq, bits)


def frame(table: Table, docs: list[tuple[int, np.ndarray]]) -> bytes:
    """A frame of documents (key, unsigned 32-bit ids)."""
    ids = np.concatenate([x for _, x in docs])
    coded = [table.encode(ids[a:a + FRAME_TOKENS]) for a in range(0, len(ids), FRAME_TOKENS)]
    words, state = [w for x, _ in coded for w in x], np.concatenate([s for _, s in coded])
    sizes = np.array([len(w) for w in words], np.int64)
    first = np.cumsum(sizes) - sizes
    check = [zlib.crc32(ids[a:a + BLOCK_TOKENS].tobytes()) for a in range(0, len(ids), BLOCK_TOKENS)]
    index = np.array([(i, len(x)) for i, x in docs], "<i8")
    directory = first.astype("<u8").tobytes() + state.astype("<u8").tobytes() + np.array(check, "<u4").tobytes()
    parts = [zlib.compress(x, 1) for x in (index.tobytes(), directory)]
    body = b"".join([struct.pack("<Q", len(parts[0])), parts[0], struct.pack("<Q", len(parts[1])), parts[1], *[w.tobytes() for w in words]])
    return _HEAD.pack(MAGIC, _HEAD.size + len(body), len(docs), len(ids), table.crc, zlib.crc32(body)) + body


class Frame:
    """A frame at an offset of a file."""

    def __init__(self, data: memoryview, at: int, table: Table):
        magic, self.length, docs, self.n, crc, check = _HEAD.unpack_from(data, at)
        body = data[at + _HEAD.size: at + self.length]
        if magic != MAGIC or at + self.length > len(data) or zlib.crc32(body) != check:
            raise ValueError("not a whole frame")
        if crc != table.crc:
            raise ValueError("the frame belongs to another frequency table")
        self.table, k = table, 0
        parts = []
        for _ in range(2):
            size = struct.unpack_from("<Q", body, k)[0]
            parts.append(zlib.decompress(body[k + 8: k + 8 + size]))
            k += 8 + size
        self.index = np.frombuffer(parts[0], "<i8").reshape(docs, 2)
        self.blocks = -(-self.n // BLOCK_TOKENS)
        self.first = np.frombuffer(parts[1], "<u8", self.blocks)
        self.state = np.frombuffer(parts[1], "<u8", self.blocks * LANES, 8 * self.blocks).reshape(self.blocks, LANES)
        self.check = np.frombuffer(parts[1], "<u4", self.blocks, 8 * self.blocks * (1 + LANES))
        self.words = np.frombuffer(body, "<u4", offset=k)

    def read_range(self, a: int, b: int) -> np.ndarray:
        """Ids a to b of the frame, from the blocks that hold them alone."""
        if a >= b:
            return np.zeros(0, "<u4")
        x, y = a // BLOCK_TOKENS, -(-b // BLOCK_TOKENS)
        sizes = np.full(y - x, BLOCK_TOKENS)
        sizes[-1] = min(self.n, y * BLOCK_TOKENS) - (y - 1) * BLOCK_TOKENS
        got = self.table.decode(self.words, self.first[x:y], self.state[x:y], sizes)
        for k in range(x, y):
            if zlib.crc32(got[(k - x) * BLOCK_TOKENS:(k - x + 1) * BLOCK_TOKENS].tobytes()) != self.check[k]:
                raise ValueError("a block's checksum differs")
        return got[a - x * BLOCK_TOKENS: b - x * BLOCK_TOKENS]

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """(key, ids) of each document, from runs of blocks of bounded size."""
        ends = np.cumsum(self.index[:, 1])
        runs = groupby(zip(self.index[:, 0].tolist(), (ends - self.index[:, 1]).tolist(), ends.tolist()), lambda d: d[1] // FRAME_TOKENS)
        for _, run in runs:
            run = list(run)
            a = run[0][1]
            ids = self.read_range(a, run[-1][2])
            yield from ((key, ids[x - a: y - a]) for key, x, y in run)


# ------------------------------------------------------------------- files
def _frames(table: Table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, size = [], 0

        def made():
            return pa.RecordBatch.from_arrays([pa.array([frame(table, docs)], pa.binary())], ["value"])

        for batch in batches:
            for i, n, ids in zip(batch.column("_id").to_pylist(), batch.column("n").to_pylist(), batch.column("ids")):
                docs.append((i, _unpacked(n, ids.as_py()).astype("<u4")))
                size += n
                if size >= FRAME_TOKENS:
                    yield made()
                    docs, size = [], 0
        if docs:
            yield made()
    return run


def write_tokens(tokens: DataFrame, path: str) -> None:
    """Write (_id, n, ids) rows in ascending order of ``_id``: files of frames under
    ``path/ids``, the frequency table under ``path/table``."""
    spark = tokens.sparkSession
    # As many rows as the vocabulary has ids.
    counts = tokens.select("n", "ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    table = scaled([r["id"] for r in counts], [r["n"] for r in counts])
    rows = [(int(i), int(table.freq[i]), int(table.bits)) for i in table.ids]
    files = -(-sum(r["n"] for r in counts) // FILE_TOKENS) or 1
    with shuffle_cleanup(spark):
        spark.createDataFrame(rows, "id long, freq long, bits int").coalesce(1).write.parquet(f"{path}/table")
        ordered = tokens.repartitionByRange(files, "_id").sortWithinPartitions("_id")
        # The text writer writes the bytes of a string as they are.
        (ordered.mapInArrow(_frames(table), "value binary").select(F.col("value").cast("string"))
         .write.option("maxRecordsPerFile", FILE_FRAMES).text(f"{path}/ids"))


def read_table(spark: SparkSession, path: str) -> Table:
    """The shared frequencies; as many rows as the vocabulary has ids."""
    rows = spark.read.parquet(f"{path}/table").orderBy("id").collect()
    return Table(np.array([r["id"] for r in rows], np.int64), np.array([r["freq"] for r in rows], np.int64), rows[0]["bits"] if rows else 16)


def _read(table: Table, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data, at = memoryview(content.as_buffer()), 0
                while at < len(data):
                    one = Frame(data, at, table)
                    rows = [(key, len(ids), zlib.crc32(ids.tobytes()), ids.view("<i4") if keep_ids else None) for key, ids in one.documents()]
                    n = np.array([r[1] for r in rows], np.int64)
                    cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array(np.full(len(rows), rows[0][0]), pa.int64()),
                            pa.array(np.cumsum(n) - n), pa.array(n), pa.array([r[2] for r in rows], pa.int64())]
                    names = ["_id", "frame", "before", "n_tokens", "ids_crc32"]
                    if keep_ids:
                        cols, names = [*cols, pa.array([r[3] for r in rows], pa.list_(pa.int32()))], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(cols, names)
                    at += one.length + 1
    return run


def read_tokens(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """(_id, frame, before, n_tokens, ids_crc32[, ids]) of the documents in the files:
    ``frame`` is the first key of its frame, ``before`` the ids before it there."""
    schema = "_id long, frame long, before long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids").select("content")
    return files.mapInArrow(_read(read_table(spark, path), keep_ids), schema)


def token_files(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> DataFrame:
    """Write the token files of ``docs`` under ``path`` and read them back. One row per
    input row: the id, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``."""
    spark = docs.sparkSession
    prepare(spark)
    base = with_ids(docs, id_col, text_col)
    write_tokens(tokenised(base, vocabulary, end_id), path)
    rows = cut_lineage(read_tokens(spark, path), "read")
    totals = running_totals(rows.groupBy("frame").agg(F.sum("n_tokens").alias("n")), "frame", ["n"])
    out = rows.join(totals.select("frame", (F.col("cum_n") - F.col("n")).alias("base")), "frame")
    out = out.select("_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    if base.where(~F.col("_id").eqNullSafe(F.col("_doc"))).isEmpty():
        out = out.withColumn("_doc", F.col("_id").cast(base.schema["_doc"].dataType))
    else:
        out = out.join(base.select("_id", "_doc"), "_id")
    return out.select(F.col("_doc").alias(id_col), "start", "n_tokens", "ids_crc32")


def token_round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """``token_files`` in the shared folder."""
    return token_files(docs, scratch_path(docs.sparkSession, "token_files"), vocabulary, end_id=end_id)
