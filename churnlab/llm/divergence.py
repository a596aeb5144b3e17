"""Source divergence audit: how far the sources of a language are from each other,
and which terms make a source differ from its language.

Texts become bags of terms. For every language an MLlib ``CountVectorizer`` with
a minimum document count and the largest integer vocabulary size turns the
documents into exact sparse vectors. Entries of the vectors are summed by source,
so that a group is a sparse vector of counts too. With N occurrences in a group
and V terms in the language, a count c is the scaled, smoothed share
``p = 1 + floor(SCALE * (c + 1) / (N + V))``, and the divergence of share p from
share q is ``floor((p - q)^2 / q)``; all of it is integer arithmetic.

Divergence between two sources is summed over all terms of the language. Terms
that neither source holds all have one value, so only the sparse entries are
evaluated: by blocks of terms, each task adding its pairs up before the shuffle.

A vocabulary passes through the driver and is broadcast, as CountVectorizer does.
Its size is bounded: a language with more than ``max_terms`` distinct terms
(counted over all texts in a part of the hash range) is dealt by a hash of the term into slices, each with all
occurrences of its terms and a CountVectorizer of its own. Document counts and
sums stay exact, and the slices partition one written table, so the work stays in
proportion to the input. There is one fit for each language and slice.

Null text, lang and source count as empty strings; every row is a document, so
repeated rows count each time, whatever their ids. Texts of any length are read
whole. Ties in a ranking go by the item's UTF-8 bytes. A group without terms has
its rows of part ``pair``; an empty table gives an empty result. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlab.llm.common import prepare, text_slices
from churnlab.session import cut_lineage, scratch_path, shuffle_cleanup

#: A term is a run of ASCII letters, lower-cased, and characters beyond ASCII (bytes from 0x80).
_LETTERS = bytes(c | 0x20 if chr(c) in ascii_uppercase else c if c >= 0x80 or chr(c) in ascii_lowercase else 0x20 for c in range(256))
SCALE = 1_000_000_000
#: Distinct terms are counted in one of so many parts of the hash range, to size slices.
SAMPLED = 64
#: Sums that a task holds before it gives them out.
HELD_ENTRIES = 1_500_000
#: Entries in a block of terms, on average.
BLOCK_ENTRIES = 100_000
_COUNTS = "_k int, tid long, term string, lang_n long, held array<struct<source: string, n: long>>"


def _written(rows: DataFrame, name: str, *parts: str) -> DataFrame:
    """A scratch table with a folder for each value of ``parts``."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    with shuffle_cleanup(spark):
        rows.write.partitionBy(*parts).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_LETTERS).split()


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (_kind 0) for each text: its distinct terms in ``once``, the further occurrences in ``again``, with one space
    between. And for each slice of texts and language a row (_kind 1) whose ``once`` has those of its distinct terms whose
    hash falls in a SAMPLED-th of all."""
    for batch in batches:
        for part in text_slices(batch):
            ks, once, again = part.column("_k").to_pylist(), [], []
            found: dict[int, set[bytes]] = {k: set() for k in ks}
            for k, t in zip(ks, part.column("_text").cast(pa.large_binary()).to_pylist()):
                terms = Counter(terms_of(t))
                found[k].update(terms)
                once.append(b" ".join(terms))
                again.append(b" ".join([t for t, n in terms.items() if n > 1 for _ in range(n - 1)]))
            once += [b" ".join([t for t in ts if zlib.crc32(t) % SAMPLED == 0]) for ts in found.values()]
            again += [b""] * len(found)
            sources = pa.chunked_array([part.column("source"), pa.nulls(len(found), pa.string())]).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.array([*ks, *found], pa.int32()), pa.array([0] * len(ks) + [1] * len(found), pa.int32()), sources,
                 pa.array(once, pa.binary()).cast(pa.string()), pa.array(again, pa.binary()).cast(pa.string())], ["_k", "_kind", "source", "once", "again"])


def term_texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> tuple[DataFrame, dict[int, str]]:
    """(_k, _kind, source, once, again), a folder for each language and kind (``_term_rows``),
    and the languages by number."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("_text"))
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())
    number = F.array_position(F.array(*map(F.lit, langs)).cast("array<string>"), F.col("lang")) - 1
    rows = rows.select(number.cast("int").alias("_k"), "source", "_text").mapInArrow(_term_rows, "_k int, _kind int, source string, once string, again string")
    return _written(rows, "terms", "_k", "_kind"), dict(enumerate(langs))


def _terms(text: str) -> Column:
    return F.when(F.col(text) == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(value[order], first) if len(key) else value


def _group_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source, idx, n): sparse vectors (source, indices, values) added up by source.
    At most about HELD_ENTRIES sums are held; more are given out and begun anew."""
    number: dict[str, int] = {}
    keys, values, held = [], [], 0

    def given():
        key, value = _summed(keys, values)
        names = pa.array(list(number), pa.string()).take(pa.array(key >> 32))
        return pa.RecordBatch.from_arrays([names, pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(value)], ["source", "idx", "n"])

    for batch in batches:
        group = np.array([number.setdefault(s, len(number)) for s in batch.column("source").to_pylist()], np.int64)
        idx, n = batch.column("indices"), batch.column("values")
        size = np.diff(np.asarray(idx.offsets))
        key, value = _summed([np.repeat(group << 32, size) + np.asarray(idx.flatten())], [np.asarray(n.flatten()).astype(np.int64)])
        keys.append(key)
        values.append(value)
        held += len(key)
        if held > HELD_ENTRIES:
            keys, values = ([x] for x in _summed(keys, values))
            held = len(keys[0])
            if held > HELD_ENTRIES // 2:
                yield given()
                keys, values, held = [], [], 0
    if keys:
        yield given()


def vector_sums(rows: DataFrame, min_docs: int) -> DataFrame | None:
    """(idx, term, lang_n, held): sums of the documents' sparse vectors, a row for each
    kept term with its total and the groups (source, n) that have it; None if no term is in
    ``min_docs`` documents. ``rows``: (source, once, again), arrays of a document's distinct terms and of their further
    occurrences; document counts need the first alone, so the fit reads nothing else."""
    spark = rows.sparkSession
    vectorizer = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=(1 << 31) - 1)
    try:
        model = vectorizer.fit(rows.select(F.col("once").alias("terms")))
    except IllegalArgumentException as e:
        if "vocabulary size should be > 0" not in str(e):
            raise
        return None
    path = scratch_path(spark, "vocabulary")
    model.save(path)  # the driver's JVM writes it; nothing comes to Python
    vocabulary = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("idx", "term"))
    vector = F.unwrap_udt("vector")
    sums = model.transform(rows.select("source", F.concat("once", "again").alias("terms"))).select("source", vector["indices"].alias("indices"), vector["values"].alias("values"))
    # Tasks have added up their own; one exchange by term then serves both aggregates.
    sums = sums.mapInArrow(_group_sums, "source string, idx int, n long").repartition("idx")
    sums = sums.groupBy("idx", "source").agg(F.sum("n").alias("n"))
    sums = sums.groupBy("idx").agg(F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("held"))
    return sums.join(vocabulary, "idx")


def term_counts(texts: DataFrame, langs: dict[int, str], min_docs: int, max_terms: int) -> DataFrame:
    """(_k, tid, term, lang_n, held): every kept term with its occurrences in the language
    and in every group that has it; ``tid`` numbers the terms of a language."""
    spark = texts.sparkSession
    if not langs:
        return spark.createDataFrame([], _COUNTS)
    sampled = texts.where("_kind = 1").select("_k", F.explode(_terms("once")).alias("t")).groupBy("_k").agg(F.countDistinct("t").alias("n"))
    slices = {r["_k"]: -(-SAMPLED * r["n"] // max_terms) for r in sampled.collect()}
    out = []
    for k in langs:
        own, n = texts.where((F.col("_k") == k) & (F.col("_kind") == 0)).select("source", *(_terms(c).alias(c) for c in ("once", "again"))), slices.get(k, 1)
        if n > 1:
            dealt = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda s: F.struct(
                s.cast("int").alias("_slice"), *(F.filter(c, lambda t: F.pmod(F.xxhash64(t), F.lit(n)) == s).alias(c) for c in ("once", "again"))))
            own = _written(own.select("source", F.inline(dealt)).where(F.size("once") > 0).hint("rebalance", "_slice"), "slices", "_slice")
        for s in range(n):
            sums = vector_sums(own.where(F.col("_slice") == s) if n > 1 else own, min_docs)
            if sums is not None:
                sums = sums.select(F.lit(k).alias("_k"), (F.lit(s << 32) + F.col("idx")).alias("tid"), "term", "lang_n", "held")
                out.append(cut_lineage(sums, "counts"))
    if not out:
        return spark.createDataFrame([], _COUNTS)
    counts = out[0]
    for x in out[1:]:
        counts = counts.unionByName(x)
    return counts


def share(n: str, total: str, v: str) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + v)), exact for any counts."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + 1 as decimal(19, 0))) div cast({total} + {v} as decimal(19, 0))")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _int_divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def pair_sums(tid: np.ndarray, g: np.ndarray, p: np.ndarray, none: np.ndarray) -> np.ndarray:
    """[s, t]: the divergence of s from t summed over the terms of a block, less what
    it would be if neither held the term. An entry is term ``tid`` of group ``g``
    with share ``p``; ``none`` has each group's share for a term it lacks."""
    size, f = len(none), _int_divergence
    both_lack = f(none[:, None], none[None, :])
    out = np.zeros((size, size), np.int64)
    for t in range(size):
        np.add.at(out[:, t], g, f(p, none[t]) - both_lack[g, t])  # the term is in s
        np.add.at(out[t], g, f(none[t], p) - both_lack[t, g])  # the term is in the other
    at = np.unique(tid, return_inverse=True)[1]
    for s in range(size):
        own = np.zeros(at.max(initial=-1) + 1, np.int64)
        own[at[g == s]] = p[g == s]
        a, held = own[at], own[at] > 0
        a, b, t = a[held], p[held], g[held]  # terms that both have: what the two lines above took for each alone
        np.add.at(out[s], t, f(a, b) - f(a, none[t]) - f(none[s], b) + both_lack[s, t])
    return out


def _pair_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, entries, none in zip(batch.column("_k").to_pylist(), batch.column("entries"), batch.column("none")):
            tid, g, p = (np.asarray(entries.values.field(c)) for c in ("tid", "g", "p"))
            out = pair_sums(tid, g, p, np.asarray(none.values))
            s, t = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), k, np.int32)), pa.array(s.astype(np.int32)),
                                              pa.array(t.astype(np.int32)), pa.array(out[s, t])], ["_k", "s", "t", "part"])


def pair_values(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(_k, source, item, value) for every ordered pair of sources of a language.
    ``entries``: (_k, g, tid, p); ``groups``: (_k, source, g, none, v)."""
    blocks = -(-entries.count() // BLOCK_ENTRIES) or 1
    rows = (entries.groupBy("_k", F.pmod(F.xxhash64("tid"), F.lit(blocks)).alias("block"))
            .agg(F.collect_list(F.struct("tid", "g", "p")).alias("entries")))
    shares = F.transform(F.array_sort(F.collect_list(F.struct("g", "none"))), lambda x: x["none"])
    rows = rows.join(groups.groupBy("_k").agg(shares.alias("none")), "_k")
    sums = (rows.select("_k", "entries", "none").mapInArrow(_pair_blocks, "_k int, s int, t int, part long")
            .groupBy("_k", "s", "t").agg(F.sum("part").alias("part")))
    one = groups.select("_k", F.col("source"), F.col("g").alias("s"), F.col("none").alias("p"), "v")
    other = groups.select("_k", F.col("source").alias("item"), F.col("g").alias("t"), F.col("none").alias("q"))
    pairs = one.join(other, "_k").where("s != t").join(sums, ["_k", "s", "t"], "left")
    lacking = F.when(F.col("v") > 0, divergence(F.col("p"), F.col("q")) * F.col("v")).otherwise(0)
    return pairs.select("_k", "source", "item", (lacking + F.coalesce("part", F.lit(0))).cast("long").alias("value"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = 3, top_terms: int = 200, max_terms: int = 2_000_000) -> DataFrame:
    """(lang, source, part, item, value, rank). Part ``pair``: the divergence of the
    group from every other source of its language, all ranks. Part ``term``: the
    terms with a larger share in the group than in its language, ``top_terms`` ranks."""
    spark = docs.sparkSession
    prepare(spark)
    texts, langs = term_texts(docs, text_col, lang_col, source_col)
    counts = term_counts(texts, langs, min_docs, max_terms)
    sizes = counts.groupBy("_k").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = counts.select("_k", F.inline("held")).groupBy("_k", "source").agg(F.sum("n").alias("total"))
    groups = texts.where("_kind = 0").groupBy("_k", "source").agg(F.count("*").alias("docs")).join(totals, ["_k", "source"], "left").join(sizes, "_k", "left")
    groups = groups.na.fill(0, ["v", "total", "lang_total"]).withColumns({
        "g": (F.row_number().over(Window.partitionBy("_k").orderBy("source")) - 1).cast("int"),
        "none": F.when(F.col("v") > 0, share("0", "total", "v")).otherwise(1)})
    groups = cut_lineage(groups, "groups")
    shares = counts.join(sizes, "_k").select("_k", "tid", "term", share("lang_n", "lang_total", "v").alias("q"), F.inline("held"))
    entries = shares.join(groups.drop("docs"), ["_k", "source"]).withColumn("p", share("n", "total", "v"))
    entries = cut_lineage(entries.select("_k", "source", "g", "tid", "term", "p", "q"), "entries")
    pairs = pair_values(entries, groups).withColumn("part", F.lit("pair"))
    over = entries.where("p > q").select("_k", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("_k", "source").orderBy(F.desc("value"), "item")))

    over = ranked(over).where(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    names = spark.createDataFrame(list(langs.items()), "_k int, lang string")
    out = ranked(pairs).unionByName(over).join(names, "_k")
    return out.select("lang", "source", "part", "item", "value", "rank")
