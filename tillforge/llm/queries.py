"""The queries over the given tables, one per operator, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillforge.llm import hard_negatives as negatives
from tillforge.llm import prefix_trie as tries
from tillforge.llm import url_filters as urls
from tillforge.llm.chat import chat_digests
from tillforge.llm.decontamination import contamination
from tillforge.llm.licences import known_digests, scan
from tillforge.llm.line_dedup import judged_lines
from tillforge.llm.near_duplicates import near_duplicates
from tillforge.llm.neighbours import nearest
from tillforge.llm.packing import pack
from tillforge.llm.personal_data import personal_data
from tillforge.llm.quality import quality_scores
from tillforge.llm.store import read
from tillforge.llm.toxicity import toxicity


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_lines(read(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digests(read(spark, sf_dir, "conversations"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every vector whose id is divisible by 100; candidates: all others."""
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"), known_digests(spark))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(read(spark, sf_dir, "conversations"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf_dir, "pages"), urls.standard_rules(spark))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: every vector whose id is divisible by 50; candidates: all others."""
    vectors = negatives.relabelled(read(spark, sf_dir, "embeddings"))
    return negatives.hard_negatives(vectors, negatives.is_anchor_of_query())


OPERATORS = (
    op1_decontamination,
    op2_toxicity,
    op3_line_dedup,
    op4_chat,
    op5_near_duplicates,
    op6_personal_data,
    op7_quality,
    op8_neighbours,
    op9_packing,
    op10_licences,
    op11_prefix_trie,
    op12_url_filters,
    op13_hard_negatives,
)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (*OPERATORS, pipeline)}
ORACLES: dict[str, str] = {
    "op11_prefix_trie": tries.ORACLE,
    "op12_url_filters": urls.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
