"""Corpus pipeline over ``documents``: quality rules, line dedup, near-duplicate removal, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read back as the next stage's ``docs``. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattflow.llm import line_dedup, mixing, near_dedup, packing, quality
from wattflow.llm.frames import stored

def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line-frequency rule reject go; near copies count as one document."""
    return quality.keep_good(docs)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines above the host's boilerplate ratio go from the texts; ``n_chars`` follows; near copies count as one page."""
    return line_dedup.without_boilerplate(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of smallest id."""
    return near_dedup.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # near-duplicate search, tokenising and packing are beyond SQL; tests hold the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
