"""From raw documents to packed training sequences, one table per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import decontaminate, neardup, packing, quality_rules, spans
from skyledger.llm.workers import let_workers_import
from skyledger.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    A NULL or empty text has no words and is rejected. Repeated rows are judged alike; all columns
    come through as they are, whatever their names. An empty table gives an empty table.
    """
    let_workers_import(spark)
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8).

    The least doc_id of a group stays. Of several rows with one doc_id one stays, by hashes of its
    text and of the row. Rows without doc_id stay, and texts without words are in no group. Columns
    come through as they are.
    """
    let_workers_import(spark)
    return neardup.keep_one(docs)


def repeated_span_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences that an earlier document has too; n_chars follows the text.

    NULL and empty texts stay as they are, and documents that lose every sentence stay with an empty
    text. Other columns come through. An empty table gives an empty table.
    """
    let_workers_import(spark)
    cut = spans.without_repeats(docs)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", length).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item.

    NULL and empty texts hold none and stay; NULL and empty items match nothing. Repeated rows are
    judged alike, and all columns come through. Without items every document stays.
    """
    benchmark = let_workers_import(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.without_leaks(docs, benchmark)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences, one row per piece, without other columns.

    A NULL or empty text is one piece with the end id alone. Repeated rows are packed each.
    """
    let_workers_import(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_spans", repeated_span_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: Signatures, edit distance and token ids are not SQL; the tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in `sf_dir`, each over the written table of the one before."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
