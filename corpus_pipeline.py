"""The corpus pipeline: documents in, packed training sequences out, five operators one after the other."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import mixing, near_dedup, packing, quality, substrings
from newsloom.llm.common import spool
from newsloom.llm.tokens import tokenizer_path
from newsloom.session import with_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    """A local session without a shared folder gets one, as in tests."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(with_scratch(spark), docs, sf_dir)

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept; the trees learn from the labels of these documents."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@_stage
def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_one(docs)


@_stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that an earlier place holds."""
    return substrings.remove_repeats(docs)


@_stage
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the target mix, a row for each epoch that takes one."""
    return mixing.mix_documents(docs)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 2048."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", one_of_near_duplicates),
    ("substring_dedup", without_repeats),
    ("source_mix", mixed_sources),
    ("best_fit_packing", packed),
]

#: Signatures, trees and token ids cannot be expressed in SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; each stage's result is written before the next one reads it."""
    docs = with_scratch(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
