"""The corpus pipeline: from raw documents to packed training sequences.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm import decontaminate, langid, packing, secrets, simhash
from rankloom.llm.common import load, written
from rankloom.llm.queries import language_dictionaries, word_tokenizer

CAPACITY = 2048
WINDOW = 10


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: no letter, or a tie between languages. Learned from the stage's own input."""
    return langid.accepted(docs, language_dictionaries(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, the one with the smallest id: shingles of three words and two
    bits, as the contract of the SimHash query has them."""
    return simhash.one_of_each(docs, shingle=3, limit=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go."""
    return decontaminate.decontaminated(docs, load(spark, sf_dir, "benchmark"), WINDOW, remove="documents")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark."""
    return secrets.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces with their place in a sequence of at most 2,048 tokens."""
    return packing.pack(docs, word_tokenizer(), CAPACITY, added=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Compression, tokenizer and packing have no SQL; tests/llm holds the pipeline against a plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared checkpoint folder."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if (name, stage) != STAGES[-1]:
            docs = written(docs, name)
    return docs
