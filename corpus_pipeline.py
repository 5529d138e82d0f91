"""A training-data pipeline of five of the operators over ``documents``.

Each stage works on all rows that the one before kept and, but for the last,
returns the columns of its input. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import jaccard, language, mixing, pieces, quality_rules
from tripflow.llm.text import table, written


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose source is rejected, go."""
    return quality_rules.keep_good(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of which no language has half the letters, go."""
    return language.keep_identified(docs, language.fit(language.training_rows(docs)))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return jaccard.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, in the order of the mix."""
    return mixing.in_mixed_order(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids, same, position): every document encoded, whether its
    ids decode to its text, and its place in the mix, which depends on the rows
    alone and so is that of the stage before."""
    mixed = mixing.mix(docs).select("doc_id", "text", F.col("_position").alias("position"))
    return pieces.encode_documents(mixed, pieces.model_bytes(), keep=("position",))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

# Language scores and merges of pieces are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the whole ``documents`` table, each
    stage's result written as Parquet to the shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
