"""A corpus pipeline: language ID, near-duplicates, benchmark leaks, source mix, shards.

Every stage gets the rows that the one before it kept, as written Parquet, and returns a DataFrame. All but
the last return the columns of their input: stages that reject leave rows out, and the mix repeats a
document as often as it is used. The last returns every row's shard and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from touchline.llm import decontaminate, language, mixing, near_dedup, sharding
from touchline.session import stored


def identify(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language; a null text or one without letters is in none."""
    return language.with_language(docs)


def deduplicate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the least doc_id."""
    return near_dedup.deduplicated(docs)


def remove_leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources uses it."""
    return mixing.mixture(docs)


def shard(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every row."""
    return sharding.shards(docs)


STAGES = [
    ("language", identify),
    ("near_dedup", deduplicate),
    ("decontaminate", remove_leaks),
    ("mix", mix),
    ("shard", shard),
]

#: Trained models and seeded hashes are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
