"""SentencePiece encoding and decoding over a relational lattice.

Texts are normalised (spaces become U+2581, one goes in front) and fall apart
into words: no piece has U+2581 after another character. Word counts are taken
over all documents. For the ``lexicon_words`` most frequent words the lattice is a
relation: substrings of bounded length are exploded, equi-joined to the piece
table, grouped by word as edges (rank, start, end), and folded by Spark's
``aggregate``. That lexicon, of a size bounded by the parameter, goes to all
tasks, which encode every document in one pass. Words outside it are encoded in
the task by the same rule (``merged``, or ``fold`` for very long words and runs of
spaces), so every word of every text is encoded the same way.

The fold is over edges in order of rank, not over positions: the models here
are merge (BPE) models, whose encoding is not the path of the best total score.
An edge is taken if both its ends are still boundaries and exactly one boundary
lies between, i.e. if it joins two neighbouring symbols; that boundary goes.
What no piece covers becomes byte pieces. ``tests/llm`` compares with the
``sentencepiece`` library.

Null and empty texts have no pieces.

Repeated rows, and rows with repeated or null ids, are each encoded; texts and words
of any length are encoded whole; edges of one rank are folded from the left. An empty
table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import text_slices, with_ids
from churnlab.session import cut_lineage

SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Words of the relational lexicon: their boundaries fit in the bits of a long,
#: and one U+2581 at most (its runs are joined apart, see ``_space_runs``).
MAX_WORD = 62


class Vocabulary:
    """Pieces of a model file: ``rank`` and id by piece, byte pieces, texts by id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(model.get_piece_size())]
        plain = [i for i, s in enumerate(special) if not s and not model.is_byte(i)]
        rank = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        self.rank = {model.id_to_piece(i): rank[model.get_score(i)] for i in plain}
        self.id = {model.id_to_piece(i): i for i in plain}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.text = [b"" if s else model.id_to_piece(i).replace(SPACE, " ").encode() for i, s in enumerate(special)]
        for b, i in enumerate(self.byte):
            self.text[i] = bytes([b])
        self.longest = max(map(len, self.id))
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("the model has pieces that span words")
        if model.unk_id() in self.byte:
            raise ValueError("the model has no byte pieces")
        #: Lengths of pieces that are runs of U+2581; they are no edges.
        self.runs = {len(p) for p in self.id if len(p) > 1 and set(p) == {SPACE}}
        for k in self.runs:
            del self.rank[SPACE * k]
        #: Rank of every piece of two characters or more, and -1 for what only begins one.
        self.begin: dict[str, int] = {}
        for p in self.rank:
            for k in range(2, len(p) + 1):
                self.begin.setdefault(p[:k], -1)
        self.begin.update((p, r) for p, r in self.rank.items() if len(p) > 1)

    def fold(self, word: str) -> int:
        """The boundaries that stay, as bits 0..len(word)."""
        get, n, edges = self.begin.get, len(word), []
        for s in range(n - 1):
            for e in range(s + 2, min(n, s + self.longest) + 1):
                r = get(word[s:e])
                if r is None:
                    break
                if r >= 0:
                    edges.append((r, s, e))
        edges.sort()
        mask = (2 << n) - 1
        for _, s, e in edges:
            ends = (1 << s) | (1 << e)
            if mask & ends == ends:
                inner = mask & ((1 << e) - (2 << s))
                if inner and not inner & (inner - 1):
                    mask ^= inner
        return self._space_runs(word, mask) if SPACE * 2 in word else mask

    def _space_runs(self, word: str, mask: int) -> int:
        """Runs of U+2581 have one rank, the last, whatever their length: of
        those that can be joined the leftmost are, again and again."""
        single = 0
        while single < len(word) and word[single] == SPACE and mask >> (single + 1) & 1:
            single += 1
        sizes: list[int] = []  # nothing but the last one can be joined with what follows
        for _ in range(single):
            if sizes and sizes[-1] + 1 in self.runs:
                sizes[-1] += 1
                while len(sizes) > 1 and sizes[-2] + sizes[-1] in self.runs:
                    last = sizes.pop()
                    sizes[-1] += last
            else:
                sizes.append(1)
        at = np.cumsum([0, *sizes]).tolist()
        return (mask >> (single + 1) << (single + 1)) | sum(1 << b for b in at)

    def merged(self, word: str) -> list[int]:
        """The pieces of a word by joining its best-ranked neighbours, leftmost
        first, until none can be: what ``fold`` and ``ids`` give, in half the time
        for short words."""
        get, last = self.rank.get, len(self.rank) + 1
        parts = list(word)
        ranks = [get(a + b, last) for a, b in zip(parts, parts[1:])]
        while ranks:
            r = min(ranks)
            if r == last:
                break
            i = ranks.index(r)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], last)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], last)
        out = []
        for p in parts:
            i = self.id.get(p)
            out += [self.byte[x] for x in p.encode()] if i is None else [i]
        return out

    def ids(self, word: str, mask: int) -> list[int]:
        """The pieces between the boundaries of a word."""
        out, a, mask = [], 0, mask >> 1
        while mask:
            step = (mask & -mask).bit_length()
            b = a + step
            mask >>= step
            i = self.id.get(word[a:b])
            if i is None:
                out += [self.byte[x] for x in word[a:b].encode()]
            else:
                out.append(i)
            a = b
        return out

    def decode(self, ids) -> str:
        """The text of ids; the space in front goes."""
        raw = b"".join([self.text[i] for i in ids])
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def words(text: str) -> list[str]:
    """The words of a text. One U+2581 in front of each is left out; a word that
    has none there, or more, keeps its own and begins with a line feed, which
    stands for "written in full" (no word begins with one otherwise, as a U+2581
    comes first)."""
    if not text:
        return []
    if SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " " and text[0] != "\n" and " \n" not in text:
        return text.split(" ")
    out = []
    for w in _WORD.findall(SPACE + text.replace(" ", SPACE)):
        plain = w[0] == SPACE and len(w) > 1 and w[1] not in (SPACE, "\n")
        out.append(w[1:] if plain else "\n" + w)
    return out


def spelled(word: str) -> str:
    """A word of ``words`` in full."""
    return word[1:] if word[0] == "\n" else SPACE + word


def _count_rows(batches: Iterator[pa.RecordBatch], flush: int = 300_000) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        # A word met once among so many is no frequent one; the lexicon's choice changes the work only.
        some = [(spelled(w), n) for w, n in held.items() if n > 1 and len(w) < MAX_WORD and w[0] != "\n"]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())],
                                          ["word", "n"])
    for batch in batches:
        for part in text_slices(batch):
            for text in part.column("_text").to_pylist():
                held.update(words(text))
            if len(held) >= flush:
                yield out()
                held.clear()
    yield out()


def frequent_words(base: DataFrame, most: int) -> DataFrame:
    """(word): the most frequent ones of those the relation can hold, by counts over all texts
    that leave out words met once between two flushes of a task. The choice changes the work only."""
    counts = base.select("_text").mapInArrow(_count_rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return cut_lineage(counts.orderBy(F.desc("n"), "word").limit(most).select("word"), "words")


def lattice_lexicon(found: DataFrame, path: str) -> DataFrame:
    """(word, mask): the boundaries of each word that stay, by DataFrame operations."""
    spark = found.sparkSession
    v = vocabulary(path)
    table = spark.createDataFrame([(p, r) for p, r in v.rank.items() if len(p) > 1], "piece string, rank int")
    found = found.repartition("word").withColumn("size", F.length("word"))
    starts = found.select("word", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 2, F.lit(0)))).alias("s"))
    ends = starts.select("word", "size", "s", F.explode(F.expr(f"sequence(least(s + 2, size), least(size, s + {v.longest}))")).alias("e"))
    pieces = ends.withColumn("piece", F.expr("substring(word, s + 1, e - s)"))
    # A word's rows are in one task, so the grouping needs no shuffle; the piece table is bounded by the model.
    edges = (pieces.join(F.broadcast(table), "piece").withColumn("edge", F.expr("(cast(rank as bigint) * 64 + s) * 64 + e"))
             .groupBy("word", "size").agg(F.sort_array(F.collect_list("edge")).alias("edges")))
    fold = """aggregate(edges, shiftleft(2L, size) - 1, (m, x) ->
        if((shiftright(m, cast(shiftright(x, 6) & 63 as int)) & 1) = 1 and (shiftright(m, cast(x & 63 as int)) & 1) = 1
           and bit_count(m & (shiftleft(1L, cast(x & 63 as int)) - shiftleft(2L, cast(shiftright(x, 6) & 63 as int)))) = 1,
           m & ~(shiftleft(1L, cast(x & 63 as int)) - shiftleft(2L, cast(shiftright(x, 6) & 63 as int))), m))"""
    return edges.select("word", F.expr(fold).alias("mask"))


#: Columns that ``sp_encode`` can make, and their types.
_OUT = {"ids": pa.list_(pa.int32()), "decoded": pa.string(), "n_ids": pa.int64(), "ids_crc32": pa.int64(), "decoded_sha256": pa.string()}
_SQL = {"ids": "array<int>", "decoded": "string", "n_ids": "long", "ids_crc32": "long", "decoded_sha256": "string"}


#: Encodings a Python worker keeps between its tasks: of the lexicon's words, and of some others.
_KEPT: dict = {}
_RARE_WORDS = 200_000


def _kept(key: str) -> tuple[dict[str, tuple], dict[str, tuple]]:
    if _KEPT.get("key") != key:
        _KEPT.clear()
        _KEPT.update(key=key, known={}, rare={})
    return _KEPT["known"], _KEPT["rare"]


def _encode(path: str, lexicon, columns: tuple[str, ...]):
    """``lexicon``: a broadcast of boundaries by word."""
    back = any(c.startswith("decoded") for c in columns)
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, masks = vocabulary(path), lexicon.value
        known, rare = _kept(key)

        def encode(w: str) -> tuple:
            mask = masks.get(w)
            if mask is not None:
                ids = known[w] = tuple(v.ids(SPACE + w, mask))
                return ids
            ids = rare.get(w)
            if ids is None:
                full = spelled(w)
                ids = v.merged(full) if len(full) <= MAX_WORD and w[0] != "\n" else v.ids(full, v.fold(full))
                if len(rare) >= _RARE_WORDS:
                    rare.clear()
                ids = rare[w] = tuple(ids)
            return ids

        for batch in batches:
            for part in text_slices(batch):
                out: dict[str, list] = {c: [] for c in columns}
                for text in part.column("_text").to_pylist():
                    ids: list[int] = []
                    for w in words(text):
                        ids += known.get(w) or encode(w)
                    packed = np.array(ids, "<i4")
                    text = v.decode(ids) if back else None
                    for c, values in out.items():
                        values.append(packed if c == "ids" else len(ids) if c == "n_ids" else text if c == "decoded"
                                      else zlib.crc32(packed.tobytes()) if c == "ids_crc32"
                                      else hashlib.sha256(text.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("_doc"), *(pa.array(x, _OUT[c]) for c, x in out.items())],
                                                 ["_doc", *columns])
    return run


def sp_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = 400_000,
              columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """One row per input row: the id and ``columns``: ``ids``; ``decoded``, the
    text that the ids give back (a U+2581 of the input is a space there);
    ``n_ids``, ``ids_crc32`` (little-endian 32-bit ids), ``decoded_sha256``."""
    base = with_ids(docs, id_col, text_col)
    lexicon = lattice_lexicon(frequent_words(base, lexicon_words), path).toArrow()
    masks = dict(zip((w[1:] for w in lexicon.column("word").to_pylist()), lexicon.column("mask").to_pylist()))
    schema = f"_doc {base.schema['_doc'].dataType.simpleString()}, " + ", ".join(f"{c} {_SQL[c]}" for c in columns)
    masks = docs.sparkSession.sparkContext.broadcast(masks)  # at most lexicon_words entries
    return base.select("_doc", "_text").mapInArrow(_encode(path, masks, columns), schema).withColumnRenamed("_doc", id_col)


def sp_decode(frame: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``frame`` with the text of a column of ids; null ids give null."""
    @F.pandas_udf("string")
    def text(ids):
        v = vocabulary(path)
        return ids.map(v.decode, na_action="ignore")

    return frame.withColumn(out_col, text(F.col(ids_col)))

