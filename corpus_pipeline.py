"""A corpus from documents to token ids: stages that each keep whole tables.

Rejects low quality, keeps one of each group of near copies, masks personal data,
mixes the sources and encodes the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackside.llm import frames, mixing, personal, pieces, quality, simhash
from trackside.sources import tables


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; learnt from `labels`."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept(docs, labels, ~frames.held_out("id", 4, 2))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.representatives(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return personal.masked_rows(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' weights want them, in random order."""
    return mixing.mixed(docs, numbered=False)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids beside each document."""
    return pieces.with_ids(docs, pieces.vocabulary(pieces.tokenizer()))


STAGES = [
    ("quality_classifier", good),
    ("simhash_near_dedup", distinct),
    ("personal_data", masked),
    ("mix_sources", mixed),
    ("sentencepiece", encoded),
]

#: No stage but the mix can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tables.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
