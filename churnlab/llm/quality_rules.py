"""Quality rules, line first.

Every line with a word is put to three rules on its own:

* punctuation: it fails if over a tenth of its characters are markup symbols
  or over three tenths of its words end in two exclamation or question marks;
* navigation: it fails if it has at least three separators between entries
  (a bar or an angle quote with spaces around it);
* boilerplate: it fails if it holds one of the stock phrases of licences,
  cookie notices and page furniture.

Failing lines are removed; a document is rejected if they held more than
``max_lost`` of its words. Two document rules come first: too few words, and too
many words in repeated 5-word windows.

A null or empty text has no words and is rejected. Each row is judged by its own
text alone, in one pass without a shuffle.

Repeated rows, and rows with repeated or null ids, are each judged; texts of any length
are read whole; a document at exactly ``max_lost`` stays. An empty table gives an empty
result; other columns, whatever their names, are not read, and pass through
``keep_good`` unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import prepare

SYMBOLS = "#*$%&|<>"
PHRASES = ("all rights reserved", "apache license", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy",
           "sign up for our newsletter", "terms of service", "terms of use")
_SYMBOLS = SYMBOLS.encode()
_PHRASES = tuple(p.encode() for p in PHRASES)
_SHOUT = re.compile(rb"[!?]{2}(?=[\x20\x09-\x0D]|\Z)")
_SEPARATOR = re.compile(rb" (?:\||\xc2\xbb) ")


def line_fails(line: bytes, n_words: int) -> bool:
    """The three rules, on a line with ``n_words`` > 0 words."""
    marks = len(line) - len(line.translate(None, _SYMBOLS))
    if marks and 10 * marks > len(line):
        return True
    if b"!" in line or b"?" in line:
        if 10 * len(_SHOUT.findall(line)) > 3 * n_words:
            return True
    if b" | " in line or b"\xc2\xbb" in line:
        if len(_SEPARATOR.findall(line)) >= 3:
            return True
    lower = line.lower()
    return any(p in lower for p in _PHRASES)


def repeat_words(words: list[bytes], n: int = 5) -> int:
    """Number of words inside n-word windows that occur at least twice."""
    if len(words) < n:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    # Windows of growing length are numbered anew at each step, so keys are exact.
    window = ids
    for k in range(1, n):
        key = window[: len(ids) - k] * (len(number) + 1) + ids[k:]
        window = key if k == n - 1 else np.unique(key, return_inverse=True)[1]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(window) + n, np.int64)
    hit = np.concatenate((order[1:][same], order[:-1][same]))
    hit = np.unique(hit)
    np.add.at(twice, hit, 1)
    np.add.at(twice, hit + n, -1)
    return int((np.cumsum(twice) > 0).sum())


def clean(text: str | None, max_lost: float) -> tuple[tuple, str | None]:
    """What ``judge`` gives, and the text without its failing lines (None for a
    rejected document)."""
    raw = (text or "").encode()
    words = raw.split()  # of bytes: at ASCII white space only
    joined = b"".join(words)
    chars = len(joined.decode())
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    seen, dup, lines, failed, lost, left = set(), 0, 0, 0, 0, []
    for line in raw.split(b"\n"):
        n = len(line.split())
        if not n:
            left.append(line)
            continue
        lines += 1
        if line in seen:
            dup += 1
        seen.add(line)
        if line_fails(line, n):
            failed += 1
            lost += n
        else:
            left.append(line)
    repeated = repeat_words(words)
    base = len(words) < 10 or 100 * repeated > 20 * len(words)
    kept = not base and lost <= max_lost * len(words)
    counts = (len(words), chars, symbols, dup, repeated, lines, failed, lost, base, kept)
    return counts, (b"\n".join(left).decode() if failed else text) if kept else None


def judge(text: str | None, max_lost: float) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_failed_lines, lost_words, base_failed, kept)."""
    return clean(text, max_lost)[0]


_FIELDS = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
           ("n_repeat_words", "long"), ("n_lines", "long"), ("n_failed_lines", "long"), ("lost_words", "long"),
           ("base_failed", "boolean"), ("kept", "boolean"))


def _judge_rows(max_lost: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "boolean": pa.bool_()}
        for batch in batches:
            rows = [clean(t, max_lost) for t in batch.column("_text").to_pylist()]
            cols = [pa.array([r[k] for r, _ in rows], kinds[t]) for k, (_, t) in enumerate(_FIELDS)]
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), *cols, pa.array([x for _, x in rows], pa.string())],
                                             ["_doc", *[f for f, _ in _FIELDS], "kept_text"])
    return run


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = 0.5) -> DataFrame:
    """One row per input row: the id, the counts of ``judge``, base_failed, kept,
    and ``kept_text``, the text without its failing lines (null where rejected)."""
    prepare(docs.sparkSession)
    base = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = ", ".join(f"{f} {t}" for f, t in _FIELDS)
    out = base.mapInArrow(_judge_rows(max_lost), f"_doc {base.schema['_doc'].dataType.simpleString()}, {schema}, kept_text string")
    return out.withColumnRenamed("_doc", id_col)


def clean_lines(text: str | None) -> str:
    """The text without its failing lines."""
    raw = (text or "").encode()
    return b"\n".join(x for x in raw.split(b"\n") if not x.split() or not line_fails(x, len(x.split()))).decode()


def keep_good(docs: DataFrame, text_col: str = "text", max_lost: float = 0.5) -> DataFrame:
    """The rows that pass, their texts without failing lines, with all columns of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = pa.array([clean(t, max_lost)[1] for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts).filter(texts.is_valid())

    return docs.mapInArrow(run, docs.schema)
