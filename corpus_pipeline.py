"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import bpe_tree, decontaminate, host_quality, language_spans, tensor_minhash
from claimloom.llm.common import Scratch, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and come from hosts that do; NULL and empty texts go."""
    return host_quality.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that holds at least a third of their letters; without letters they go."""
    return language_spans.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the smallest id; rows without an id stay."""
    return tensor_minhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark items; those made up of them go, NULL texts stay NULL."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and the digest of what they decode to; NULL text is empty."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_tree.digest_documents(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("byte_bpe", byte_bpe),
]

#: SQL has no byte-level BPE; tests hold the rows against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.land(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
