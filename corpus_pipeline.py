"""From raw documents to packed training sequences: five stages over the whole table.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and
returns the columns of ``docs``; the last one returns the packed pieces.  All five send
whole texts to Python, so they bound the bytes of a batch for the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontamination, line_dedup, near_dup, packing, quality_crf
from tidewell.llm.common import materialise, table
from tidewell.llm.queries import vocabulary
from tidewell.session import bounded_batches


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field rejects go."""
    bounded_batches(spark)
    return quality_crf.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later near-duplicate lines go, and documents of which nothing else is left; the others have their new length."""
    bounded_batches(spark)
    cleaned = line_dedup.dedup_lines(docs, drop_emptied=True)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    bounded_batches(spark)
    return near_dup.drop_near_duplicates(docs, words=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    bounded_batches(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    bounded_batches(spark)
    return packing.pack_documents(docs, *vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("best_fit_packing", pack),
]

#: The stages train models and compare sets; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
