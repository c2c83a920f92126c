"""From raw documents to packed training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wordbond import Workspace
from wordbond.llm import exact_dedup, packing, simhash, toxicity
from wordbond.llm.shipping import share_import_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a field fitted on the labelled ones among them."""
    share_import_path(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit_toxicity(docs, labels, Workspace(spark)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without exact copies: of equal texts the largest id stays."""
    return exact_dedup.drop_exact_copies(docs, Workspace(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without near copies: of each SimHash group the smallest id stays."""
    share_import_path(spark)
    return simhash.drop_near_copies(docs, Workspace(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    share_import_path(spark)
    return packing.pack_documents(docs, Workspace(spark), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]

# Fingerprints, the field and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    workspace = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = workspace.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
