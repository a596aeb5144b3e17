"""WARC archives: writing with revisit records, reading with boundary checks.

Writing: one record per page. Payloads of at least ``min_revisit`` bytes that are
equal (by length and SHA-1) share one response record, that of the largest id;
the others become revisit records without a payload that refer to it. Spark's
text writer makes the files, with the record separator as its line separator.

Reading: Spark's text reader splits the archives at every occurrence of the
version line, so an archive of any size is read by many tasks, and a task emits
for each occurrence a candidate: its offset, and the offset of its successor
according to its Content-Length. An occurrence inside a payload is a candidate
too. Pointer jumping from offset 0 of each file then retains the records that
the chain of successors reaches. Offsets within a split are made absolute by
the sums of the splits before it. A payload that spans several candidates is put
together again from their chunks.

No task holds a file's candidates: jumping is done within parts of ``part_bytes`` of a
file, each of which gives a link from every offset at which it may be entered to the one at which
that chain leaves it; joins that double the links find the entries that the chain from offset 0
takes (one a part at most, as offsets rise), and from these the parts mark their records.

A length or page id that is no 64-bit number makes a candidate none, or its id null. A null payload is
empty; a null URL leaves out its header; line breaks in a URL become spaces.
Every row is a record, ordered by id (null first), and by ``with_ids`` where ids repeat.

Repeated rows are records of their own, and of equal payloads the last in that order
is the response; a payload of any length is one record. An empty table gives archives
without records and an empty result; columns other than id, URL and payload, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnlab.llm.common import prepare, with_ids
from churnlab.session import cut_lineage, scratch_path, shuffle_cleanup

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
_MAGIC, _END = MAGIC.encode(), END.encode()


def revisits(light: DataFrame, min_revisit: int) -> DataFrame:
    """(_id, refers): the rows that revisit another, from (_id, digest, size)."""
    rows = light.where(F.col("size") >= min_revisit)
    groups = cut_lineage(rows.groupBy("digest", "size").agg(F.max("_id").alias("refers"), F.count("*").alias("n"))
                         .where("n > 1").drop("n"), "warc_groups")
    return rows.join(groups, ["digest", "size"]).where("_id != refers").select("_id", "refers")


def write_warc(records: DataFrame, path: str, min_revisit: int = 1000, max_records: int = 100_000,
               date: str = "1970-01-01T00:00:00Z") -> None:
    """Write (_id, url, _text) rows as archives under ``path``."""
    payload = F.encode("_text", "UTF-8")
    rows = records.select("_id", "url", "_text", F.sha1(payload).alias("digest"), F.octet_length("_text").alias("size"))
    again = cut_lineage(revisits(cut_lineage(rows.select("_id", "digest", "size"), "warc_digests"), min_revisit), "warc_revisits")
    rows = rows.join(again, "_id", "left")
    own = F.col("refers").isNull()

    def header(name: str, value) -> F.Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    urn = lambda c: F.concat(F.lit("<urn:x-page:"), c.cast("string"), F.lit(">"))
    text = F.concat(
        F.lit(MAGIC), header("WARC-Type", F.when(own, "response").otherwise("revisit")), header("WARC-Record-ID", urn(F.col("_id"))),
        header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")), header("WARC-Date", F.lit(date)),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), header("WARC-Refers-To", urn(F.col("refers"))),
        header("WARC-Profile", F.when(~own, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        header("Content-Type", F.lit("text/html")), header("Content-Length", F.when(own, F.col("size")).otherwise(0).cast("string")),
        F.lit("\r\n"), F.when(own, F.col("_text")).otherwise(""))
    with shuffle_cleanup(records.sparkSession):
        (rows.select(text.alias("value")).write.mode("overwrite").option("lineSep", END)
         .option("maxRecordsPerFile", max_records).text(path))


_HEADER = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)\r\n")
_CANDIDATES = ("file string, block long, seq long, rel long, size long, head long, body long, type string, "
               "record long, refers long, sha1 string")


def parse_head(chunk: bytes) -> tuple[int, dict[str, str]] | None:
    """(length of the header block with its empty line, fields) of what follows a version line."""
    at, fields = 0, {}
    while chunk[at:at + 2] != b"\r\n":
        m = _HEADER.match(chunk, at)
        if not m:
            return None
        fields[m[1].decode().lower()] = m[2].decode("utf-8", "replace")
        at = m.end()
    return (at + 2, fields) if re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")) else None


def _urn(value: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?[0-9]{1,19})>", value or "")
    return int(m[1]) if m and -(1 << 63) <= int(m[1]) < 1 << 63 else None


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Offsets count from the split's first chunk. A file's first chunk is what
    stands before its first version line (normally nothing)."""
    at = None
    for batch in batches:
        rows = []
        for file, block, chunk in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
            if at is None or at[0] != (file, block):
                at = ((file, block), 0, 0)
            head = parse_head(chunk) if block or at[1] else None
            row = [file, block, at[1], at[2], len(chunk), None, None, None, None, None, None]
            if head:
                n, fields = head
                size = int(fields["content-length"])
                row[5:10] = [n, size, fields.get("warc-type"), _urn(fields.get("warc-record-id")), _urn(fields.get("warc-refers-to"))]
                if chunk[n + size:] == _END:
                    row[10] = hashlib.sha1(chunk[n:n + size]).hexdigest()
            rows.append(row)
            at = (at[0], at[1] + 1, at[2] + len(chunk) + len(_MAGIC))
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds],
                                         ["file", "block", "seq", "rel", "size", "head", "body", "type", "record", "refers", "sha1"])


def _jumps(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """The place of each candidate's successor among the sorted candidates; their number if it is none of them."""
    n = len(offsets)
    jump = np.minimum(np.searchsorted(offsets, successors), n)
    jump[(jump < n) & (offsets[np.minimum(jump, n - 1)] != successors)] = n
    return np.append(jump, n)


def reachable(offsets: np.ndarray, successors: np.ndarray, start: int = 0) -> np.ndarray:
    """Which candidates (in order of their offsets) the chain from ``start`` reaches, by pointer jumping."""
    n, jump = len(offsets), _jumps(offsets, successors)
    reach = np.append(offsets == start, False)
    for _ in range(max(1, n).bit_length() + 1):
        reach[jump[reach]] = True
        jump = jump[jump]
    return reach[:n]


def exits(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """For each candidate the first offset of its chain that is no candidate here, by pointer jumping."""
    n, jump = len(offsets), _jumps(offsets, successors)
    last = np.where(jump < n, jump, np.arange(n + 1))  # a chain stays at its last candidate
    for _ in range(max(1, n).bit_length() + 1):
        last = last[last]
    return successors[last[:n]]


def _part_links(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("offset", ignore_index=True)
    rows["exit"] = exits(rows["offset"].to_numpy(np.int64), rows["next"].to_numpy(np.int64))
    return rows.loc[rows["entry"], ["file", "offset", "exit"]]


def _part_chain(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("offset", ignore_index=True)
    reach = reachable(rows["offset"].to_numpy(np.int64), rows["next"].to_numpy(np.int64), int(rows["start"].iloc[0]))
    return rows.loc[reach, ["file", "offset", "next"]]


def chains(heads: DataFrame, part_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``heads`` (file, offset, next) that the chain from offset 0 of their file reaches."""
    part = lambda c: F.floor(F.col(c) / part_bytes).cast("long")
    rows = cut_lineage(heads.withColumn("part", part("offset")), "warc_heads")
    # A part may be entered where a candidate of another one ends.
    ends = rows.where(part("next") != F.col("part")).select("file", F.col("next").alias("offset")).distinct()
    marked = (rows.join(ends.withColumn("met", F.lit(True)), ["file", "offset"], "left")
              .withColumn("entry", F.coalesce("met", F.lit(False)) | (F.col("offset") == 0)))
    links = cut_lineage(marked.select("file", "part", "offset", "next", "entry").groupBy("file", "part")
                        .applyInPandas(_part_links, "file string, offset long, exit long"), "warc_links")
    begin = links.select("file", F.col("offset").alias("exit"))
    jump = cut_lineage(links.join(begin, ["file", "exit"], "left_semi").select("file", "offset", "exit"), "warc_jumps")
    reach = links.where("offset = 0").select("file", "offset")
    while not jump.isEmpty():  # a round doubles the parts that a link passes
        step = reach.join(jump, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        reach = cut_lineage(reach.unionByName(step), "warc_entries")
        onward = jump.select("file", F.col("offset").alias("exit"), F.col("exit").alias("onward"))
        jump = cut_lineage(jump.join(onward, ["file", "exit"]).select("file", "offset", F.col("onward").alias("exit")), "warc_jumps")
    entries = reach.select("file", part("offset").alias("part"), F.col("offset").alias("start"))
    return (rows.join(entries, ["file", "part"]).select("file", "part", "offset", "next", "start").groupBy("file", "part")
            .applyInPandas(_part_chain, "file string, offset long, next long"))


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("value")))


def read_warc(spark: SparkSession, path: str, part_bytes: int = 16 << 20) -> DataFrame:
    """(record, type, refers, payload_bytes, payload_digest) of the records that
    are reached; a revisit has the size and digest of the payload it refers to."""
    prepare(spark)
    found = cut_lineage(_chunks(spark, path).mapInArrow(_candidates, _CANDIDATES), "warc_candidates")
    step = F.col("size") + len(_MAGIC)
    splits = found.groupBy("file", "block").agg(F.sum(step).alias("length"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = cut_lineage(splits.withColumn("base", F.coalesce(F.sum("length").over(before), F.lit(0))), "warc_splits")
    # Offset of a chunk's version line; the first chunk of a file has none and stands before it.
    placed = found.join(splits.select("file", "block", "base"), ["file", "block"]).withColumn(
        "offset", F.col("base") + F.col("rel") - len(_MAGIC))
    placed = cut_lineage(placed.drop("base", "rel"), "warc_placed")
    heads = placed.where("head is not null").select("file", "offset", (F.col("offset") + len(_MAGIC) + F.col("head")
                                                                      + F.col("body") + len(_END)).alias("next"))
    chain = cut_lineage(chains(heads, part_bytes), "warc_chain")
    records = placed.join(chain, ["file", "offset"])
    whole = records.where("sha1 is not null").select("record", "type", "refers", F.col("body").alias("payload_bytes"), "sha1")
    broken = cut_lineage(records.where("sha1 is null").select("file", "offset", "next", "head", "body", "type", "record", "refers"),
                         "warc_broken")
    if not broken.isEmpty():
        lengths = splits.groupBy("file").agg(F.max(F.col("base") + F.col("length")).alias("end"))
        whole = whole.unionByName(_rejoined(spark, path, placed, broken.join(lengths, "file"), part_bytes))
    whole = cut_lineage(whole, "warc_records")
    full = whole.where("type = 'response'").select(F.col("record").alias("refers"), F.col("payload_bytes").alias("n"), F.col("sha1").alias("d"))
    return (whole.join(full, "refers", "left")
            .select("record", "type", "refers", F.coalesce("n", "payload_bytes").alias("payload_bytes"),
                    F.coalesce("d", "sha1").alias("payload_digest")))


def _hash_spans(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("at")
    raw = _MAGIC.join(rows["value"])
    head, body = int(rows["head"].iloc[0]), int(rows["body"].iloc[0])
    out = rows[["record", "type", "refers"]].iloc[:1].copy()
    out["payload_bytes"], out["sha1"] = body, hashlib.sha1(raw[head:head + body]).hexdigest()
    return out


def _rejoined(spark: SparkSession, path: str, placed: DataFrame, broken: DataFrame, part_bytes: int) -> DataFrame:
    """Records whose payload holds version lines, from their chunks. A group is one payload."""
    part = lambda c: F.floor(c / part_bytes).cast("long")
    names = ["start", "next", "record", "type", "refers", "head", "body"]
    spans = broken.withColumnRenamed("offset", "start").withColumn("o", F.struct(*names))
    # A record stands in every part of the file that it reaches into, at its start or at that of the part. A chunk
    # belongs to the last record before it there, if that reaches so far.
    last_byte = F.greatest("start", F.least("next", "end") - 1)
    spans = spans.select("file", "o", F.explode(F.sequence(part(F.col("start")), part(last_byte))).alias("part"))
    spans = spans.withColumn("offset", F.greatest("o.start", F.col("part") * part_bytes))
    chunks = placed.select("file", "block", "seq", "offset", part(F.col("offset")).alias("part"))
    window = Window.partitionBy("file", "part").orderBy("offset", F.col("o").isNull())
    owned = (chunks.unionByName(spans, allowMissingColumns=True).withColumn("owner", F.last("o", ignorenulls=True).over(window))
             .where("o is null").where(F.col("offset") < F.col("owner.next")))
    owned = cut_lineage(owned.select("file", "block", "seq", F.col("offset").alias("at"), "owner.*").drop("start"), "warc_owned")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            seq = []
            for key in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
                at = (key, at[1] + 1) if at and at[0] == key else (key, 0)
                seq.append(at[1])
            yield batch.append_column("seq", pa.array(seq, pa.int64()))

    chunks = _chunks(spark, path).mapInArrow(number, "file string, block long, value binary, seq long")
    return (chunks.join(owned, ["file", "block", "seq"]).groupBy("file", "next")
            .applyInPandas(_hash_spans, "record long, type string, refers long, payload_bytes long, sha1 string"))


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", text_col: str = "html", url_col: str = "url",
                    min_revisit: int = 1000, path: str | None = None) -> DataFrame:
    """Write the pages as archives and read them back: the id, payload_bytes,
    payload_digest, record_type, refers_to (the id of the response)."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    # The URL travels beside the payload only where ids need no renumbering by payload.
    named = pages.select(F.col(f"`{id_col}`").alias("_doc0"), F.col(f"`{text_col}`").cast("string").alias("_text0"),
                         F.col(f"`{url_col}`").cast("string").alias("url"))
    base = with_ids(named, "_doc0", "_text0", keep=("url",))
    write_warc(base, path, min_revisit)
    got = read_warc(spark, path)
    ids = base.select(F.col("_id").alias("record"), F.col("_doc"))
    if base.where(~F.col("_id").eqNullSafe(F.col("_doc"))).isEmpty():
        kind = base.schema["_doc"].dataType
        got = got.withColumns({"_doc": F.col("record").cast(kind), "_ref": F.col("refers").cast(kind)})
    else:
        got = got.join(ids, "record").join(ids.select(F.col("record").alias("refers"), F.col("_doc").alias("_ref")), "refers", "left")
    return got.select(F.col("_doc").alias(id_col), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                      F.col("_ref").alias("refers_to"))
