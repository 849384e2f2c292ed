"""From raw documents to token files: the training-data pipeline.

Each stage takes (spark, docs, sf_dir), works on all that the stage before
kept, and returns a DataFrame that is written as Parquet and read again. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimflow.llm import dac, decontaminate, jaccard, mixing, quality
from claimflow.llm.common import fresh, materialize, read, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or leave their language's bands go."""
    ship(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that with the least id."""
    ship(spark)
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go."""
    ship(spark)
    return decontaminate.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target rate draws it, in random order."""
    ship(spark)
    return mixing.mix(docs).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, in the order of the mix; a row for each document in them."""
    ship(spark)
    place = fresh("shuffle_key", docs.columns)
    return dac.round_trip(mixing.with_shuffle_keys(docs, name=place), order=place)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

#: The tokenizer and the MinHash signatures have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
