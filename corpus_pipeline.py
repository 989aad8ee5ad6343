"""A corpus pipeline: quality rules, near duplicates, secrets, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns what the next one works on; all but the last return the
columns of ``documents``. The caller writes each result as Parquet and reads it again as the next one's docs.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import mixing, pieces, repetition, secret_scan, simhash
from tallyhouse.llm.common import DOCUMENT_COLUMNS, kept, table
from tallyhouse.llm.queries import TOKENIZER

#: No stage can be put into SQL; the tests hold the result against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return repetition.keep_good(docs.select(*DOCUMENT_COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id."""
    return simhash.one_of_each(docs.select(*DOCUMENT_COLUMNS), width=3, bits=2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and n_chars counted anew."""
    return secret_scan.mask_secrets(docs.select(*DOCUMENT_COLUMNS))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document taken twice is there twice; rows of one shard lie together in shuffled order."""
    return mixing.mixed(docs.select(*DOCUMENT_COLUMNS)).select(*DOCUMENT_COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids, and the text they decode to, a row for every row of the mix."""
    return pieces.round_trip(docs, Path(TOKENIZER).read_bytes())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixed_sources),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
