"""A training corpus from raw documents: five stages, each one operator, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import stage
from millrace.llm.mixing import mixed
from millrace.llm.quality import keep_good
from millrace.llm.queries import tokenizer_path
from millrace.llm.simhash import one_per_group
from millrace.llm.spaced_seeds import without_contaminated
from millrace.llm.token_store import document_digests
from millrace.sources.tables import fixture


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs stay."""
    return keep_good(docs, fixture(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id."""
    return one_per_group(docs, distance=4, shingle=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return without_contaminated(docs, fixture(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return mixed(docs, weights=(3, 1, 2), share=1.5, cap=2)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in coded files; place, length and checksum of each document's ids, read back."""
    return document_digests(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("token ids", tokens),
]

# Tokenization cannot be said in SQL; tests/llm/test_pipeline.py replays every stage by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again as the next one's input."""
    docs = fixture(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
