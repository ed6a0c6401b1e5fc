"""A training-corpus pipeline: language ID, near duplicates, benchmark leaks, source mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontam, jaccard, langid, mixing, sharding
from millrace.llm.common import materialise, table

#: Shards of the mixture's splitting tree and of the last stage.
SHARDS = 8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in one of the known languages; null texts and texts without letters go."""
    return langid.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the least doc_id."""
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each time that a document is taken."""
    return mixing.mixed_rows(docs, shards=SHARDS).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their ``shard`` and ``slot``."""
    return sharding.interleave(docs, SHARDS)


STAGES = [
    ("language id", language_id),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("source mixture", mix_sources),
    ("sharding", shard),
]

#: MinHash, SVD and the splitting tree aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
