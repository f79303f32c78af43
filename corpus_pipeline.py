"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on all rows that its predecessor kept, and its rows are written
as Parquet and read again by the next one.  All stages but the last return the
columns of the documents, and leave other columns alone whatever they are called; the
column of texts is ``text``, the key ``doc_id``.

Defined results: a null or empty text is rejected by the first stage, as are texts of
fewer than 50 words; very long texts go through every stage whole; of equal or similar
documents the one with the smallest id stays, of rows that repeat an id the first as
text; an empty table gives an empty result in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardloom.llm import decontaminate, minhash, packing, pii, quality_rules
from cardloom.llm.common import table, written
from cardloom.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, similarity 0.8)."""
    return minhash.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts give way to the names of their kinds."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("minhash", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packed),
]

#: Token ids come from a tokenizer library, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
