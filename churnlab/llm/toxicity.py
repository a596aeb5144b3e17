"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

1. Language model: character trigrams over a-z, a class for other letters and a
   word boundary, counted over the whole of all documents. Tasks count into an
   array and emit one row per trigram, so what is gathered is bounded by 28^3.
2. Channel: a word that holds a digit or sign beside a letter, letters repeated three
   times or more or two doubled letters, or that is spelled out, becomes a lattice: each
   place has its possible letters, each with a cost. Viterbi decoding under the language
   model picks the most likely original.
3. Lexicon: learned from at most ``max_rows`` labelled rows (those with the
   smallest hashed ids). For each restored word, and each word beginning of 4 to 6
   letters, the number of toxic and other documents that hold it, counted before
   the shuffle; the ``max_terms`` terms of the highest log-odds (in standard
   errors) are the lexicon. Two more lexicons are learned from one half of the
   labelled rows each.
4. Score: per document, the strongest weights, their sums and densities; boosted
   trees are fitted on the same rows, whose numbers come from the lexicon of the
   other half, so that a word seen once can't vouch for itself.

Null and empty texts hold no term and get a score like any other.

Repeated rows, and rows with repeated or null ids, are each scored; a null id is not
held out and has no label; every label of an id is learned as it stands. Texts and words
of any length are read whole. Of readings of one cost the first is taken; terms of one
weight go by their text; a score equal to the threshold counts as 1. Without labels all
scores are equal; an empty table gives an empty result; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import text_slices, utf8, with_ids
from churnlab.llm.labels import fit_sample, remainder, scored, with_labels
from churnlab.session import cut_lineage

# --- the language model -------------------------------------------------

#: Classes: 0 word boundary, 1-26 a-z, 27 any other letter.
CLASSES = 28
_CODE = np.zeros(256, np.int64)
_CODE[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CODE[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_CODE[128:] = 27


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES ** 3, np.int64)
    for batch in batches:
        for part in text_slices(batch):
            data, offsets = utf8(part)
            # A boundary between documents, and two at the ends.
            code = np.insert(_CODE[data], np.unique(offsets), 0)
            code = np.concatenate(([0], code, [0]))
            key = (code[:-2] * CLASSES + code[1:-1]) * CLASSES + code[2:]
            # Of runs of boundaries only the edges count.
            total += np.bincount(key[(code[1:-1] != 0) | (code[2:] != 0)], minlength=CLASSES ** 3)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["gram", "n"])


def language_model(base: DataFrame) -> np.ndarray:
    """Costs (negative log2 probabilities) of a class after two others, from all texts."""
    counts = base.select("_text").mapInArrow(_trigrams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    tri = np.zeros(CLASSES ** 3)
    tri[np.asarray(counts.column("gram").combine_chunks(), np.int64)] = np.asarray(counts.column("n").combine_chunks(), np.float64)
    tri = tri.reshape(CLASSES, CLASSES, CLASSES)
    bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
    p1 = (uni + 1) / (uni.sum() + CLASSES)
    p2 = (bi + 4 * p1) / (bi.sum(axis=1, keepdims=True) + 4)
    p3 = (tri + 4 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 4)
    return -np.log2(p3)


# --- the channel --------------------------------------------------------

#: Letters that a sign may stand for (fixed values).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
#: Bits of the channel: a sign read as a letter, a separator dropped, a run of letters cut to
#: one or to two, a separator kept, a sign that is none of the letters.
_SIGN, _DROP, _ONE, _TWO, _SPLIT, _KEEP_SIGN = 1.0, 0.5, 0.5, 1.5, 3.0, 12.0
_RUN = re.compile(r"(.)\1{2,}", re.S)
_DOUBLE = re.compile(r"([^\W\d_])\1")
#: What may stand after a character that is spelled on its own.
_AFTER = ".,;:?!\"')"
#: Characters in a row, each a token, from which they are read as a word.
SPELLED = 3
_MARKUP = re.compile(r"([$|+])\1\1")
_EDGE = ".,;:?!\"'()[]{}<>*%&#|$+~`"


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """The possible readings of each place of a lower-case token, with their costs."""
    out, at = [], 0
    while at < len(token):
        c = token[at]
        n = 1
        while at + n < len(token) and token[at + n] == c:
            n += 1
        if c in LEET:
            read = [(x, _SIGN) for x in LEET[c]] + [(" ", _KEEP_SIGN)]
        elif c.isalpha():
            read = [(c, 0.0)]
        else:
            read = [("", _DROP), (" ", _SPLIT)]
        if n == 2 and c.isalpha():
            out.append([(c * 2, 0.0), (c, _ONE)])
        elif n >= 3 and (c.isalpha() or c in LEET):
            out.append([(x * k, cost + (_ONE if k == 1 else _TWO)) for x, cost in read for k in ((1, 2) if x.strip() else (1,))])
        else:
            out += [read] * (n if c.isalpha() or c in LEET else 1)
        at += n
    return out


def _class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27


def decode(token: str, cost: np.ndarray) -> str:
    """The cheapest reading of a token: Viterbi over (last two classes)."""
    best = {(0, 0): (0.0, None)}  # state: cost, (text so far as a linked list)
    for places in [*lattice(token), [(" ", 0.0)]]:
        now: dict[tuple[int, int], tuple] = {}
        for (a, b), (c0, path) in best.items():
            for text, c1 in places:
                p, q, c = a, b, c0 + c1
                for ch in text:
                    k = _class(ch)
                    if k == 0 and q == 0:
                        continue
                    c += float(cost[p, q, k])
                    p, q = q, k
                if (p, q) not in now or c < now[p, q][0]:
                    now[p, q] = (c, (path, text))
        best = now
    path, parts = min(best.values(), key=lambda x: x[0])[1], []
    while path:
        path, text = path
        parts.append(text)
    return "".join(reversed(parts)).strip()


def _obfuscated(token: str) -> bool:
    """Whether a lower-case word, its outer signs gone, goes to the lattice: with a letter,
    every one that holds a sign or a digit, a run of three or two doubled letters."""
    if token.isalpha():
        return _RUN.search(token) is not None or len(_DOUBLE.findall(token)) > 1
    return any(map(str.isalpha, token))


def single(token: str) -> str:
    """The one character that a token is, but for signs after it; else an empty text."""
    c = token if len(token) == 1 else token[:1] if not token[1:].strip(_AFTER) else ""
    return c if c and (c.isalpha() or c in LEET) else ""


class Restorer:
    """Restores words; readings of recent tokens are kept."""

    def __init__(self, cost: np.ndarray):
        self.read = lru_cache(maxsize=50_000)(lambda t: tuple(decode(t, cost).split()))

    def token(self, raw: str) -> list[str]:
        """The words of one lower-case token. A word with signs at its edge is
        read with and without them (they may be letters: ``$tupid``, ``(lown``). Tokens
        without a letter are numbers and signs, and no words."""
        token = raw.strip(_EDGE)
        if not token:
            return []
        if _obfuscated(token):
            out = list(self.read(token))
            if token.isalpha():  # repeated letters: the reading with all of them doubled, too
                out.append(_RUN.sub(r"\1\1", token))
            else:  # and the words between the signs
                out += [x for x in re.split(r"[\W\d_]+", token) if len(x) > 1 and x not in out]
        elif token.isalpha():
            out = [token]
            if _DOUBLE.search(token):  # one doubled letter, with and without its double
                out.append(_DOUBLE.sub(r"\1", token))
        else:
            out = []
        if raw != token:
            outer = raw.strip(".,;:?\"'")
            edge = outer != token and (outer[:1] in LEET or outer[-1:] in LEET)
            if edge and not _MARKUP.search(outer) and any(map(str.isalpha, outer)):
                out += [x for x in self.read(outer) if x not in out]
        return out

    def spelled(self, tokens: list[str]) -> list[str]:
        """The words spelled out over runs of at least ``SPELLED`` one-character tokens."""
        out, run = [], []
        for t in [*tokens, ""]:
            if c := single(t):
                run.append(c)
                continue
            if len(run) >= SPELLED:
                out += self.read(" ".join(run))
            run = []
        return out

    def words(self, text: str) -> list[str]:
        """The restored lower-case words of a text."""
        tokens = text.lower().split()
        return self.spelled(tokens) + [w for t in tokens for w in self.token(t)]


# --- the lexicons -------------------------------------------------------

BEGINNINGS = (4, 5, 6)


def terms(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *("^" + word[:k] for k in BEGINNINGS if len(word) >= k)]


class Terms:
    """How often each term occurs in a text; with ``known``, of those alone. What
    a token gives is kept for ``most`` tokens at a time."""

    def __init__(self, cost: np.ndarray, known: set[str] | None = None, most: int = 100_000):
        self.restorer, self.known, self.most = Restorer(cost), known, most
        self.of: dict[str, tuple[str, ...]] = {}
        if known is not None:
            self.whole = {t for t in known if t[0] != "^"}
            self.begin = [(k, {t[1:] for t in known if t[0] == "^" and len(t) == k + 1}) for k in BEGINNINGS]

    def _terms(self, words: list[str]) -> tuple[str, ...]:
        out: list[str] = []
        for w in words:
            if self.known is None:
                out += terms(w)
                continue
            if w in self.whole:
                out.append(w)
            for k, begin in self.begin:
                if w[:k] in begin:  # a shorter word is in none, as those have k letters
                    out.append("^" + w[:k])
        return tuple(out)

    def count(self, text: str) -> tuple[dict[str, int], int]:
        """(times by term, number of tokens)."""
        tokens = text.lower().split()
        found: dict[str, int] = {}
        counts = Counter(tokens)
        of = self.of
        if len(of) > self.most:
            of.clear()
        for token, n in counts.items():
            own = of.get(token)
            if own is None:
                own = of[token] = self._terms(self.restorer.token(token))
            for t in own:
                found[t] = found.get(t, 0) + n
        alone = {t for t in counts if single(t)}
        if sum([counts[t] for t in alone]) >= SPELLED:
            for t in self._terms(self.restorer.spelled(tokens)):
                found[t] = found.get(t, 0) + 1
        return found, len(tokens)


def _term_counts(cost: np.ndarray, flush: int = 200_000):
    """Pre-aggregated (term, n0, n1, t0, t1): documents and toxic documents of either half."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held = Terms(cost), {}

        def out() -> pa.RecordBatch:
            x = np.array(list(held.values()), np.int64).reshape(-1, 4)
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array(x[:, k]) for k in range(4))],
                                              ["term", "n0", "n1", "t0", "t1"])
        for batch in batches:
            for text, label, half in zip(*(batch.column(c).to_pylist() for c in ("_text", "label", "half"))):
                for t in reader.count(text)[0]:
                    row = held.get(t)
                    if row is None:
                        row = held[t] = [0, 0, 0, 0]
                    row[half] += 1
                    row[2 + half] += label
                if len(held) >= flush:
                    yield out()
                    held.clear()
        yield out()
    return run


def lexicons(learn: DataFrame, cost: np.ndarray, max_terms: int, least: int = 3) -> list[dict[str, float]]:
    """Weights learned from the first half, the second half, and all of the
    labelled rows (_text, label, half): the ``max_terms`` terms with the highest
    log-odds in standard errors among those in at least ``least`` documents."""
    counts = cut_lineage(learn.select("_text", "label", "half").mapInArrow(_term_counts(cost), "term string, n0 long, n1 long, t0 long, t1 long")
                         .groupBy("term").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "t0", "t1")]), "terms")
    size = {(r["half"], r["label"]): r["count"] for r in learn.groupBy("half", "label").count().collect()}
    out = []
    for halves in ((0,), (1,), (0, 1)):
        toxic = float(sum(size.get((h, 1), 0) for h in halves))
        other = float(sum(size.get((h, 0), 0) for h in halves))
        t = sum((F.col(f"t{h}") for h in halves), F.lit(0))
        n = sum((F.col(f"n{h}") for h in halves), F.lit(0))
        a, b = t + 0.5, n - t + 0.5
        odds = F.log(a / (toxic - t + 1.0)) - F.log(b / (other - (n - t) + 1.0))
        error = F.sqrt(1 / a + 1 / b)
        top = (counts.where(n >= least).select("term", odds.alias("w"), (odds / error).alias("z")).where("z > 1.5")
               .orderBy(F.desc("z"), "term").limit(max_terms))
        out.append({r["term"]: r["w"] for r in top.collect()})
    return out


def _numbers(found: dict[str, int], n_words: int, weights: dict[str, float]) -> list[float]:
    hits = [(weights[t], k) for t, k in found.items() if t in weights]
    if not hits:
        return [0.0] * 10 + [np.log1p(n_words)]
    w, times = zip(*hits)
    total, count = sum([x * k for x, k in hits]), sum(times)
    size = max(1, n_words)
    return [*(sorted(w, reverse=True) + [0.0] * 4)[:4], sum(w), float(len(w)), total / size, count / size, float(count),
            float(max(times)), np.log1p(n_words)]


_WIDTH = 11


def _features(cost: np.ndarray, weights: list[dict[str, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Terms(cost, set().union(*weights), most=300_000)
        for batch in batches:
            cols = [[] for _ in weights]
            for text in batch.column("_text").to_pylist():
                found, n = reader.count(text)
                for c, w in zip(cols, weights):
                    c.append(_numbers(found, n, w))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_doc"), *(pa.array(c, pa.list_(pa.float32(), _WIDTH)).cast(pa.list_(pa.float32())) for c in cols)],
                ["_id", "_doc", "x0", "x1", "x"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", folds: int = 5, held_out: int = 0, threshold: float = 0.5,
                    max_rows: int = 50_000, max_terms: int = 5_000) -> DataFrame:
    """One row per input row: the id, held_out (crc32 of the id modulo ``folds``
    is ``held_out``; such rows are not learned from), score, predicted. A null
    id is not held out and has no label."""
    base = with_ids(docs, id_col, text_col)
    cost = language_model(base)
    half = F.pmod(F.xxhash64("_doc"), F.lit(2)).cast("int")
    own = with_labels(base.select("_id", "_doc"), labels, label_col, id_col).where(remainder("_doc", folds) != held_out)
    own = cut_lineage(own.select("_id", "label", half.alias("half")).orderBy(F.xxhash64("_id"), "_id", "label").limit(max_rows), "labelled")
    # At most max_rows small rows, so the texts stay where they are read.
    weights = lexicons(base.join(F.broadcast(own), "_id"), cost, max_terms)
    kind = base.schema["_doc"].dataType.simpleString()
    numbers = cut_lineage(base.mapInArrow(_features(cost, weights),
                                          f"_id long, _doc {kind}, x0 array<float>, x1 array<float>, x array<float>"), "toxicity")
    learn = numbers.join(F.broadcast(own), "_id").select("_id", "label", F.when(F.col("half") == 0, F.col("x1")).otherwise(F.col("x0")).alias("x"))
    trees = fit_sample(learn, "x", max_rows, least=5.0)
    return scored(numbers, trees, "x", id_col, remainder(id_col, folds) == held_out, threshold)
