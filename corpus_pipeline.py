"""The corpus pipeline: toxicity, line dedup, near duplicates, benchmark decontamination, packing.

Every stage takes what the one before kept, in the columns of ``documents``; the last returns the packing.

Defined cases: documents without an id or text are kept and packed like others, and null, empty and word-free texts are
near duplicates of each other, so one of them stays; very long texts are read whole by every stage; of equal rows one stays;
ties are broken by the smaller doc_id, then by the hash of the text; an empty table gives an empty packing; columns that no
stage uses are carried along as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slicemill.llm import decontamination, line_templates, ngram_join, packing, toxicity
from slicemill.llm.common import written
from slicemill.plans.registry import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine rejects go; it learns from ``labels``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring line templates leave all documents but their first one."""
    return line_templates.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return ngram_join.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontamination.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of what is left in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", line_dedup), ("ngram_join", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
