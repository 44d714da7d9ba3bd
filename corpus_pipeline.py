"""From raw documents to packed training sequences.

Each stage works on what its predecessor kept, stored as Parquet.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.language_id import accept, fit, held_out
from tallymart.llm.packing import pack
from tallymart.llm.secret_scan import redact_documents
from tallymart.llm.shingle_join import one_of_each
from tallymart.llm.support import materialise, table

CAPACITY = 2048


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; learnt from their own labels, held-out ids excepted."""
    return accept(docs, fit(docs.filter(~held_out())))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity, the one with the smallest id."""
    return one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and ``n_chars`` counted anew."""
    redacted = redact_documents(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=CAPACITY)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# Models, hashes and tokenizers are beyond SQL; the tests look at the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
