"""Stages that make packed training sequences of the table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import written
from tickloom.llm.linechunks import without_repeats
from tickloom.llm.minmax import one_of_each
from tickloom.llm.packing import packed
from tickloom.llm.pii import mask_documents
from tickloom.llm.toxicity import without_toxic


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled ones among ``docs``."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines are taken out of the texts; every document stays."""
    return without_repeats(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, on shingles of five words, the document of least id stays."""
    return one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; every document stays."""
    return mask_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of the texts are placed in sequences: one row per piece."""
    return packed(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack),
]

# Learned scores, signatures and tokens can't be stated in SQL: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table, each written as Parquet before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
