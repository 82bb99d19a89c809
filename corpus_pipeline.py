"""A training corpus from documents: quality, exact copies, near copies, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registra.llm import exact, mixing, near, packing, quality
from registra.llm.common import table, written
from registra.llm.queries import RATES, TARGETS, WINDOW, WORD_TOKENIZER


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score 0.7 or more. Empty and NULL texts are scored like others; repeated rows share their fate; any columns, no rows
    too, are as good."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that differ in white space alone, the smallest doc_id's. NULL and empty texts are one group; a
    row without doc_id stays only if no other has its text; of repeated rows one stays."""
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the smallest doc_id. Texts without words are one class; rows that share a doc_id
    go each with their own text."""
    return near.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row at least once, rows of rare languages more often. Texts without words are documents like others; where the
    targets are out of reach, and in an empty table, nothing changes."""
    return mixing.mixed_documents(docs, table(spark, sf_dir, "labels"), TARGETS, **RATES)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: where its ids lie in the sequences. An empty or NULL text is its end id alone; repeated rows,
    such as copies of the stage before, are documents of their own; no rows give no rows."""
    return packing.pack_documents(docs, WORD_TOKENIZER, WINDOW, end_id=1)


STAGES = [
    ("quality", good_documents),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# A trained model, hashing and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last written for the next to read.

    What becomes of NULLs, empty and long texts, repeated rows and empty tables is told at each stage; other
    columns of the documents, whatever their names, are carried to the last stage.
    """
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)
