"""From raw documents to packed training sequences, in stages that each read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinlog.llm import decontaminate, line_dedup, near_dedup, packing, quality
from skeinlog.llm.common import cut, table
from skeinlog.llm.queries import tokenizer_paths


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules reject go. Null and empty texts are rejected."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that came earlier, or one character off, go; documents stay, also one that has no line left."""
    return line_dedup.keep_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least doc_id."""
    return near_dedup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten neighbouring words of a benchmark item, or all of a shorter one, go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of packing.TOKENS tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"), *tokenizer_paths())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Votes learned by expectation-maximisation, components and packing have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Nulls, repeated rows and empty tables pass as the operators say."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir).select(
        "doc_id", "piece", "start", "length", F.col("ids_crc32"), "sequence_id", "offset"
    )
