"""Corpus pipeline: from raw documents to packed training sequences.

Each stage gets all documents its predecessor kept, and its decisions take effect: rejected and
near-duplicate documents are gone, repeated and benchmark passages are cut out of their texts.

In every stage a null text counts as an empty one; texts may be of any length and extra columns
of any name, which all stages but the last return as they are. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import contamination, near, packing, quality, suffixes
from tidewatch.llm.common import stored, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. Equal texts are judged alike, empty
    ones too; repeated rows and rows without doc_id stay or go with their text. Without usable
    labels every document stays."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the least doc_id, rows without one only
    if no other is there. Repeated rows and empty texts are copies of each other."""
    return near.keep_one(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long passages that occur elsewhere. Of a passage no place is kept, so
    repeated rows of 200 bytes or more lose their whole text and stay as empty documents."""
    return suffixes.remove_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark. All documents stay, repeated rows too; one that
    is nothing but a passage is empty then. An empty benchmark changes nothing."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences. An empty text is its end alone; repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", classify),
    ("near-duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeats),
    ("decontamination", decontaminate),
    ("packing", pack),
]
# The classifier and the order of packing can't be stated in SQL: tests/llm/test_pipeline.py holds
# each stage, and the whole run, against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
