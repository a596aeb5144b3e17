"""SimHash near-duplicates with covering locality-sensitive hashing.

A document's fingerprint has 64 bits: bit j is 1 if it is set in over half of
the XXH64 hashes of its word shingles. To find all pairs of fingerprints that
differ in at most ``radius`` bits, each bit position gets a nonzero vector of
``radius + 1`` bits, in turn; the table of a nonzero vector v keeps the
positions whose vector has an odd product with v. The at most ``radius``
differing positions span too few dimensions to be odd against every v, so the
two fingerprints agree on all positions of some table: no pair is missed.

Within a bucket no pairs are formed. A fingerprint that shares a bucket emits
its neighbours at distance up to ``radius / 2`` on the positions the table
leaves free. Two fingerprints share such a neighbour if and only if they differ
in at most ``radius`` bits there, so the members of a neighbour's group are all
linked, and one link to the least of them is enough. A group has at most as
many members as a word has neighbours (65 for radius 2), however many copies.

Equal fingerprints are one node. Null and empty texts have fingerprint zero and
are linked like any other; every input row is a document of its own, so repeated
rows and repeated or null ids are linked too (ties go to the first in the order
of ``with_ids``). A text of any length is read whole. An empty table gives an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import restored, with_ids, with_rest
from churnlab.llm.components import components
from churnlab.session import cut_lineage

BITS = 64
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str, shingle: int) -> int:
    """The fingerprint of one text, unsigned."""
    words = text.encode().lower().split()  # ASCII lower case, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    n = min(shingle, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - n + 1].tolist()
    h = b"".join([xxhash.xxh64_digest(joined[a:b], 42) for a, b in zip(starts, ends[n - 1:].tolist())])
    octets = np.frombuffer(h, np.uint8).reshape(-1, 8)  # the highest byte first
    ones = np.concatenate([_BYTE_BITS.T @ np.bincount(octets[:, k], minlength=256) for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(octets)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in batch.column("_text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_doc"), pa.array(fp.view(np.int64))],
                                             ["_id", "_doc", "fp"])
    return run


def fingerprints(base: DataFrame, shingle: int) -> DataFrame:
    """(_id, _doc, fp): the fingerprint as a signed long, written out."""
    kind = base.schema["_doc"].dataType.simpleString()
    return cut_lineage(base.mapInArrow(_fingerprints(shingle), f"_id long, _doc {kind}, fp long"), "fingerprints")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def masks(radius: int) -> list[int]:
    """The tables' bit masks."""
    size = (1 << (radius + 1)) - 1
    vector = [j % size + 1 for j in range(BITS)]
    return [sum(1 << j for j in range(BITS) if (vector[j] & v).bit_count() % 2) for v in range(1, size + 1)]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that suffice for the
    components of the graph of all pairs within ``radius``, an even number."""
    if radius % 2 or not 0 < radius < 8:
        raise ValueError("radius must be 2, 4 or 6")
    full = (1 << BITS) - 1
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"),
                                F.lit(_signed(full ^ m)).alias("free")) for k, m in enumerate(masks(radius))])
    rows = distinct.select("fp", F.inline(tables))
    shared = cut_lineage(rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").select("t", "key"), "buckets")
    near = rows.join(shared, ["t", "key"], "left_semi").groupBy("fp").agg(F.collect_set("free").alias("free"))
    flips = [sum(1 << j for j in c) for n in range(radius // 2 + 1) for c in combinations(range(BITS), n)]
    flips = F.array(*[F.lit(_signed(f)) for f in flips])
    inside = F.filter(flips, lambda f: F.exists("free", lambda m: f.bitwiseAND(m) == f))
    probes = near.select("fp", F.explode(inside).alias("f")).select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("p"))
    groups = probes.groupBy("p").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("s")).where(F.size("s") > 1)
    return groups.select(F.explode("s").alias("a"), "b").where("a != b").distinct()


def near_groups(base: DataFrame, shingle: int = 5, radius: int = 2) -> DataFrame:
    """(_id, _doc, fp, least): ``least`` is the struct (_id, _doc) of the first
    document that can be reached over links, the document itself included."""
    fps = fingerprints(base, shingle)
    nodes = cut_lineage(fps.groupBy("fp").agg(F.min(F.struct("_id", "_doc")).alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), radius)).select(F.col("a").alias("fp"), "root")
    placed = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    placed = cut_lineage(placed.select("fp", "root").join(least, "root").select("fp", "least"), "placed")
    return fps.join(placed, "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                       radius: int = 2) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 lowercase hex digits),
    ``component_id`` (the smallest id reachable)."""
    out = near_groups(with_ids(docs, id_col, text_col), shingle, radius)
    return out.select(F.col("_doc").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("least._doc").alias("component_id"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = 2) -> DataFrame:
    """The first row of each group of near copies (the one with the smallest id),
    with all columns of ``docs``."""
    base = with_rest(docs, id_col, text_col)
    gone = cut_lineage(near_groups(base.drop("_rest"), shingle, radius).where("_id != least._id").select("_id"), "near_copies")
    return restored(base.join(gone, "_id", "left_anti"), docs, id_col, text_col)
