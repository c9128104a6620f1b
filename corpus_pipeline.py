"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing. Each stage works on what the last kept.

Rows without doc_id are no documents: the first stage drops them. Of repeated rows of one doc_id one stays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import common
from seriesloom.llm.common import scratch
from seriesloom.llm.near_dups import classes
from seriesloom.llm.packing import pack_documents
from seriesloom.llm.passages import cut_passages, passages
from seriesloom.llm.quality import judge


_LEFT: list[str] = []


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that first drops the tables which the one before needed for its result: that is written by now."""

    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.drop(spark, _LEFT)
        before = set(common.NAMED)
        result = function(spark, docs, sf_dir)
        _LEFT[:] = [x for x in common.NAMED if x not in before]
        return result

    return stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands."""
    kept = judge(docs, public_tokenizers.path("piece_bpe_32k.model")).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"] == kept["kept_id"], "left_semi")


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least doc_id."""
    staying = classes(docs).where("stays").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(staying, docs["doc_id"] == staying["kept_id"], "left_semi").dropDuplicates(["doc_id"])


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds; those of which nothing is left go."""
    return cut_passages(docs, passages(docs))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("repeated passages", repeated_passages), ("packing", packing)]

#: Neither the tokenisers nor the similarity stages can be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents; each stage's result is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
