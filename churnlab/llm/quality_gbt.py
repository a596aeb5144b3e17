"""Quality classifier: boosted trees over statistics of a document's whole text.

Statistics are computed in one pass over the texts and written out (a few dozen
numbers a row). The trees are fitted on at most ``max_rows`` labelled rows, which
is all that comes to the driver, and all rows are scored from the written table.
Null and empty texts have all-zero statistics and get a score like any other.

Repeated rows, and rows with repeated or null ids, are each scored; a null id is not
held out and has no label; every label of an id is learned as it stands. Texts of any
length are read whole. A score equal to the threshold counts as 1. Without labels all
scores are equal; an empty table gives an empty result; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import with_ids
from churnlab.llm.labels import fit_sample, remainder, scored, with_labels
from churnlab.session import cut_lineage

NAMES = ("chars", "words", "word_mean", "word_sd", "word_max", "lines", "line_words", "upper", "digits", "spaces", "non_ascii",
         "symbols", "stops", "commas", "marks", "bars", "entropy", "distinct", "top_word", "adjacent", "dup_lines",
         "lines_stopped", "dup_pairs", "short_words")
_BYTE = np.arange(256)
_SETS = {
    "upper": (_BYTE >= 65) & (_BYTE <= 90), "digits": (_BYTE >= 48) & (_BYTE <= 57),
    "spaces": (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)), "non_ascii": _BYTE >= 128,
    "symbols": np.isin(_BYTE, list(b"#*$%&<>@^~{}[]\\")), "stops": _BYTE == 46, "commas": _BYTE == 44,
    "marks": np.isin(_BYTE, list(b"!?")), "bars": _BYTE == 124,
}
_MASKS = np.stack(list(_SETS.values()), axis=1).astype(np.float64)


def statistics(text: str) -> list[float]:
    """The numbers of ``NAMES``, in that order."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * len(NAMES)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = count / len(raw)
    some = share[share > 0]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    freq = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.split()]
    n = len(words)
    pairs = len(set(zip(words, words[1:])))
    return [
        np.log1p(len(raw)), np.log1p(n), lengths.mean(), lengths.std(), float(lengths.max()), np.log1p(len(lines)),
        np.log1p(n / len(lines)), *(share @ _MASKS).tolist(), float(-(some * np.log2(some)).sum()), len(freq) / n,
        max(freq.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n, 1 - len(set(lines)) / len(lines),
        sum(x.rstrip()[-1:] in b".!?:;\"" for x in lines) / len(lines), 1 - pairs / max(1, n - 1), float((lengths <= 2).mean()),
    ]


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [statistics(t) for t in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_doc"), pa.array(x, pa.list_(pa.float32()))],
                                         ["_id", "_doc", "x"])


def document_statistics(base: DataFrame) -> DataFrame:
    """(_id, _doc, x): the statistics as an array, written out."""
    kind = base.schema["_doc"].dataType.simpleString()
    return cut_lineage(base.mapInArrow(_statistics_rows, f"_id long, _doc {kind}, x array<float>"), "statistics")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", folds: int = 4, held_out: int = 2, threshold: float = 0.7,
                   max_rows: int = 50_000) -> DataFrame:
    """One row per input row: the id, held_out (crc32 of the id modulo ``folds``
    is ``held_out``; such rows are not learned from), score, predicted. A null
    id is not held out and has no label."""
    stats = document_statistics(with_ids(docs, id_col, text_col))
    learn = with_labels(stats, labels, label_col, id_col).where(remainder("_doc", folds) != held_out)
    trees = fit_sample(learn, "x", max_rows)
    return scored(stats, trees, "x", id_col, remainder(id_col, folds) == held_out, threshold)
