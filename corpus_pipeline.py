"""A corpus from raw documents to packed training sequences.

Each stage is one operator with its production parameters, applied to all that
the stage before it has kept. Stage tables are written as Parquet and read back,
so a stage that is lost is run again from files. Every row is a document, with
repeated or null ids too (``churnlab.llm.common.with_ids`` orders them). A null
text counts as empty and is rejected by the first stage; texts of any length are
read whole; other columns pass through whatever their names. An empty table
gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.session import cut_lineage
from churnlab.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others lose their failing lines."""
    from churnlab.llm.quality_rules import keep_good

    out = keep_good(docs, max_lost=0.5)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    from churnlab.llm.exact_dedup import drop_exact

    return drop_exact(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near copies (fingerprints of three-word shingles, linked at
    two or fewer differing bits) the row with the smallest id stays."""
    from churnlab.llm.simhash import drop_near

    return drop_near(docs, shingle=3, radius=2)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that occurred earlier are cut out of the texts."""
    from churnlab.llm.suffix_dedup import drop_repeats

    out = drop_repeats(docs, width=100)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, placed in sequences of 1024 tokens."""
    import public_tokenizers

    from churnlab.llm.packing import best_fit_packing

    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("suffix_dedup", repeats_stage),
    ("best_fit_packing", packing_stage),
]

#: Near copies and token ids are beyond SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
