"""Fill-in-middle transformation with a sparse exception index.

A text is cut at two code points, drawn from a hash of its id, into prefix,
middle and suffix, and written in one of two orders with sentinels before the
parts: prefix, suffix, middle (psm) or suffix, prefix, middle (spm). Some texts
stay plain: empty ones, those that hold a sentinel, and a hashed share.

Texts stay UTF-8. For a slice of texts only the multibyte characters are
indexed: where each begins, as a byte and as a code point, and how many bytes it
has beyond the first. A cut at code point c is then at byte c plus the excess of
the characters before it, which one binary search in the index gives; a text of
ASCII alone has no entry and its cuts are plain arithmetic.

Null texts count as empty. Each row is transformed by its own id and text alone,
without a shuffle: repeated rows give repeated results, a null id hashes as an
empty string (rows that share an id share their draws). Texts of any length are
cut whole. An empty table gives an empty result. Other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import prepare, text_slices, utf8

SENTINELS = ("<P>", "<S>", "<M>")


class ExceptionIndex:
    """Where the multibyte characters of a run of UTF-8 bytes begin."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        #: excess[k]: bytes beyond the first of the first k multibyte characters.
        self.excess = np.concatenate(([0], np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0))))
        self.point = self.byte - self.excess[:-1]

    def points(self, at: np.ndarray) -> np.ndarray:
        """Code points before these byte offsets, which lie between characters."""
        return at - self.excess[np.searchsorted(self.byte, at)]

    def bytes(self, at: np.ndarray) -> np.ndarray:
        """Byte offsets of these code points."""
        return at + self.excess[np.searchsorted(self.point, at)]


def draws(ids: list, seed: int) -> np.ndarray:
    """Four unsigned 32-bit draws a row: the first digits of sha256 of ``seed:id``."""
    digests = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


def _transform(seed: int, plain_from: int, spm_below: int, sentinels: tuple[str, str, str]):
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                data, offsets = utf8(part)
                index, raw = ExceptionIndex(data), data.tobytes()
                begin = index.points(offsets[:-1])
                n = index.points(offsets[1:]) - begin
                h = draws(part.column("_doc").to_pylist(), seed)
                one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
                low, high = np.minimum(one, two), np.maximum(one, two)
                a, b = index.bytes(begin + low), index.bytes(begin + high)
                plain, spm = h[:, 2] % 100 >= plain_from, h[:, 3] % 100 < spm_below
                form, out = [], []
                for k, (x, y, i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), a.tolist(), b.tolist())):
                    text = raw[x:y]
                    if plain[k] or x == y or p in text or s in text or m in text:
                        form.append("plain")
                        out.append(text)
                    elif spm[k]:
                        form.append("spm")
                        out.append(b"".join((s, raw[j:y], p, raw[x:i], m, raw[i:j])))
                    else:
                        form.append("psm")
                        out.append(b"".join((p, raw[x:i], s, raw[j:y], m, raw[i:j])))
                cut = np.array([f == "plain" for f in form], bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_doc"), pa.array(n), pa.array(form, pa.string()), pa.array(low, pa.int64(), mask=cut),
                     pa.array(high - low, pa.int64(), mask=cut), pa.array(out, pa.binary()).cast(pa.string())],
                    ["_doc", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """A text without sentinels is found again only if no sentinel can begin in the end of another or hold another."""
    for x in sentinels:
        for y in sentinels:
            overlap = any(x[-k:] == y[:k] for k in range(1, min(len(x), len(y))))
            if not x or overlap or (x is not y and x in y):
                raise ValueError(f"sentinels {x!r} and {y!r} overlap")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_from: int = 90,
                   spm_below: int = 20, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """One row per input row: the id, ``n`` (code points), ``form``, ``prefix_chars``
    and ``middle_chars`` (null if plain), ``output``. Of 100 texts ``100 -
    plain_from`` stay plain and ``spm_below`` of 100 others are spm."""
    check_sentinels(sentinels)
    prepare(docs.sparkSession)
    base = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    kind = base.schema["_doc"].dataType.simpleString()
    out = base.mapInArrow(_transform(seed, plain_from, spm_below, sentinels),
                          f"_doc {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("_doc", id_col)


def restored_text(output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` was made of, as a column."""
    p, s, m = sentinels
    out = F.col(output)

    def between(text: Column, first: str, then: str) -> Column:
        return F.substring_index(F.substring_index(text, first, -1), then, 1)

    middle = F.substring_index(out, m, -1)
    psm = F.concat(between(out, p, s), middle, between(out, s, m))
    spm = F.concat(between(out, p, m), middle, between(out, s, p))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)
