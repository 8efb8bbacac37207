"""The corpus pipeline: stages over ``documents``, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillforge.llm.decontamination import remove_contaminated
from tillforge.llm.line_dedup import remove_repeated_lines
from tillforge.llm.near_duplicates import keep_one
from tillforge.llm.packing import pack
from tillforge.llm.quality import keep_good
from tillforge.llm.queries import tokenizer_path
from tillforge.llm.store import keep, read, ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one."""
    return remove_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return pack(docs, tokenizer_path())


def _shipped(stage):
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ship(spark), docs, sf_dir)

    return call


STAGES = [(f.__name__, _shipped(f)) for f in (quality, line_dedup, near_dedup, decontamination, packing)]

#: SQL has no expression for the classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
