"""From raw documents to training sequences: five stages, each an operator over all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the columns of documents, the last
one pieces of sequences. What a stage returns is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm.common import bound_batches, shipped, write_through
from rowferry.llm.decontamination import find_overlaps
from rowferry.llm.line_dedup import dedup_lines
from rowferry.llm.minhash import near_duplicates
from rowferry.llm.packing import pack_documents
from rowferry.llm.quality import features, rate_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def stage(function: Callable) -> Callable:
    """A stage ships the package and bounds the session's batches. The bounds stay, as what a stage returns runs later."""

    @shipped
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return function(spark, docs, sf_dir)

    return run


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or are more likely bad than good go."""
    # The measures are written with the texts, since they are needed for the counts of votes and again for the verdicts.
    measured = write_through(features(docs), "measures")
    return rate_quality(docs, measured=measured).where("kept").select(*COLUMNS)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all of them; ``n_chars`` follows. Documents all stay."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_duplicates(docs).where("kept").select(*COLUMNS)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with a benchmark item, or hold a shorter one, go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_overlaps(docs, items).where("not contaminated").select(*COLUMNS)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The learnt quality verdict and the packing cannot be put into SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, made in STAGES[:-1]:
        docs = write_through(made(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
