"""What the operators share: row ids, batches of bounded size.

Every input row is a document. Columns other than the id and the text are
never read, so clashing names don't matter. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlab.session import cut_lineage, ship_package

#: Arrow batches of texts, where the session still has Spark's defaults: a worker
#: holds some copies of a batch, and an executor has a worker for each core.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
            "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}
#: Python tasks work on slices of about this many bytes of text.
SLICE_BYTES = 8 << 20

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def prepare(spark: SparkSession) -> None:
    """Called by every operator: the package on the executors, small batches."""
    ship_package(spark)
    for key, (default, own) in _BATCHES.items():
        if spark.conf.get(key, None) == default:
            spark.conf.set(key, own)


def with_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(_id long, _doc, _text, *keep): one row per input row, ``_id`` unique.

    Where the id column is integral, without nulls and unique, ``_id`` is that
    column and nothing is moved. Otherwise rows are sorted by (id with nulls
    first, XXH64 of the text, text) and numbered in that order, which does not
    depend on the number of partitions: repeated ids and repeated rows become
    documents of their own, the null ids the smallest. The numbering is written
    out, so that a task run anew gives the same numbers.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.col(f"`{id_col}`").alias("_doc"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"), *keep)
    if isinstance(base.schema["_doc"].dataType, _INTEGRAL):
        clash = base.groupBy("_doc").count().where(F.col("_doc").isNull() | (F.col("count") > 1))
        if clash.isEmpty():
            return base.select(F.col("_doc").cast("long").alias("_id"), "_doc", "_text", *keep)
    ordered = base.withColumn("_h", F.xxhash64("_text"))
    ordered = (ordered.repartitionByRange(F.col("_doc").asc_nulls_first(), "_h")
               .sortWithinPartitions(F.col("_doc").asc_nulls_first(), "_h", "_text").drop("_h"))
    return cut_lineage(ordered.select(F.monotonically_increasing_id().alias("_id"), "_doc", "_text", *keep), "ids")


def text_slices(batch: pa.RecordBatch, column: str = "_text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    size = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    part = (np.cumsum(size) - size) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def utf8(batch: pa.RecordBatch, column: str = "_text") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the offsets of its rows in them."""
    col = batch.column(column).cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def sha256_hex(col: str) -> Column:
    return F.sha2(F.encode(F.col(col), "UTF-8"), 256)


def with_rest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``with_ids`` with all other columns of a row in ``_rest``, for ``restored``."""
    others = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c not in (id_col, text_col)]
    rest = F.struct(F.col(f"`{text_col}`").isNull().alias("null_text"), *others)
    return with_ids(docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"), rest.alias("_rest")),
                    "i", "t", keep=("_rest",))


def restored(rows: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``with_rest`` (with _doc, _text, _rest) as rows of ``docs``."""
    out = []
    for k, c in enumerate(docs.columns):
        value = (F.col("_doc") if c == id_col else F.when(~F.col("_rest.null_text"), F.col("_text")) if c == text_col
                 else F.col(f"_rest.c{k}"))
        out.append(value.alias(c))
    return rows.select(*out)
