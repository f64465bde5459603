"""A training corpus from raw documents, in five stages.

Each stage takes the rows that its predecessor wrote and returns what it makes of them; all but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framefold.llm import language, mixing, packing, pii, simhash_dedup
from framefold.llm.common import documents, land, prepare


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without one language for half of their words, go."""
    prepare(spark)
    return language.keep_known(docs, language.fit(language.training_rows(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with linked fingerprints the one with the smallest id stays."""
    prepare(spark)
    return simhash_dedup.keep_one(docs, simhash_dedup.SHINGLE_WORDS, simhash_dedup.DISTANCE)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    prepare(spark)
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, cut or left out until every source has its target of words."""
    prepare(spark)
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a sequence of at most 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("language_id", identify_languages),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The language model, the hashes and the tokens of the stages cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written as Parquet and read again."""
    prepare(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
