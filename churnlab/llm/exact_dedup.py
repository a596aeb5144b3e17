"""Exact duplicates by progressive refinement, in DataFrame operations only.

Rows are grouped by length, the rows of repeated lengths by a hash of a prefix,
the rows of groups repeated there by SHA-256 of the whole text. Each step is a
count with map-side partial aggregation, so a group holding a third of all rows
arrives as one row per task. The first two steps move lengths and hashes only;
whole texts are hashed for the surviving groups alone. The list of surviving
keys is written out before it is joined: Spark then knows its size (and
broadcasts it only below the session's threshold), and otherwise both sides of
the join have a shuffle of their own, so that a hot key's rows are split among
tasks at run time.

Null texts count as empty, and empty texts are equal to each other. Rows that
repeat an id are documents of their own (see ``common.with_ids``), so exactly
one row of a group stays. An empty table gives an empty result.

Texts of any length are compared whole. Of equal texts under one id the last in the
order of ``with_ids`` stays. Other columns, whatever their names, are not read here, and
pass through ``drop_exact`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import restored, sha256_hex, with_ids, with_rest
from churnlab.session import cut_lineage


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    return cut_lineage(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"), "repeated")


def exact_groups(base: DataFrame, prefix: int = 64) -> DataFrame:
    """(_id, keep_row, keep_id, group_size) of the documents that have an equal
    one; ``base`` comes from ``with_ids``. ``prefix`` (characters) changes the
    work, never the result."""
    base = base.withColumns({"_len": F.octet_length("_text"), "_pre": F.xxhash64(F.substring("_text", 1, prefix))})
    light = cut_lineage(base.select("_len", "_pre"), "lengths")
    by_length = light.join(_repeated(light, ["_len"]), ["_len"], "left_semi")
    by_prefix = _repeated(by_length, ["_len", "_pre"])
    full = cut_lineage(base.join(by_prefix, ["_len", "_pre"], "left_semi")
                       .select("_id", "_doc", sha256_hex("_text").alias("_sha")), "full")
    groups = cut_lineage(full.groupBy("_sha")
                         .agg(F.max(F.struct("_id", "_doc")).alias("_k"), F.count("*").alias("group_size"))
                         .where("group_size > 1")
                         .select("_sha", F.col("_k._id").alias("keep_row"), F.col("_k._doc").alias("keep_id"),
                                 "group_size"), "groups")
    return full.select("_id", "_sha").join(groups, "_sha").drop("_sha")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64) -> DataFrame:
    """One row per input row: the id, ``keep_id`` (id of the row that stays: the
    largest of its group), ``group_size``, ``kept``, ``text_sha256``."""
    base = with_ids(docs, id_col, text_col)
    groups = exact_groups(base, prefix)
    out = base.select("_id", "_doc", sha256_hex("_text").alias("text_sha256")).join(groups, "_id", "left")
    return out.select(F.col("_doc").alias(id_col),
                      F.when(F.col("keep_row").isNull(), F.col("_doc")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      (F.coalesce("keep_row", "_id") == F.col("_id")).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64) -> DataFrame:
    """The rows that stay, with all columns of ``docs``."""
    base = with_rest(docs, id_col, text_col)
    gone = cut_lineage(exact_groups(base.drop("_rest"), prefix).where("_id != keep_row").select("_id"), "copies")
    return restored(base.join(gone, "_id", "left_anti"), docs, id_col, text_col)
