"""The corpus pipeline: each stage works on all rows that the one before has kept, written as Parquet and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ladderworks.llm.common import scratch_root, table
from ladderworks.llm.entry import mixture
from ladderworks.llm.exact_dedup import drop_exact_copies
from ladderworks.llm.mixing import cut_text
from ladderworks.llm.packing import packed
from ladderworks.llm.quality_rules import keep_quality
from ladderworks.llm.simhash_dedup import drop_near_copies

#: The mixing stage's budget as a share of the tokens that reach it.
BUDGET_SHARE = 0.9


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mixture: repeated for each epoch that takes them, the last of a leaf cut to its budget."""
    return cut_text(mixture(docs, BUDGET_SHARE))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences; repeated documents are packed as often as they come."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", pack)]

#: SQL can express neither the robust estimates nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
