"""Cleaning and encoding of a document corpus: five stages, each one operator of ``govlake.llm``.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``docs``; the last returns the encoded corpus: one row per document that is left, with its token ids.
Stages with a classifier or a benchmark read ``labels`` and ``benchmark`` of ``sf_dir``.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns are handled as
each operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from govlake.llm.bpe import encode_documents
from govlake.llm.common import staged, table
from govlake.llm.decontaminate import drop_leaks
from govlake.llm.exact_dedup import drop_copies
from govlake.llm.queries import vocabulary_path
from govlake.llm.simhash import keep_one
from govlake.llm.toxicity import drop_toxic, learn

#: Shingle length and largest bit distance of the SimHash stage.
SHINGLE, MAX_BITS = 3, 2


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts; it learns from the labelled ones."""
    return drop_toxic(docs, learn(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash."""
    return keep_one(docs, k=SHINGLE, max_bits=MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left, with their number and the text they decode to."""
    return encode_documents(docs, vocabulary_path())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("bpe", encode),
]

#: A trained classifier, fingerprints and a tokenizer are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
