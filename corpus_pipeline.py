"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes what the stage before kept and returns the columns of documents; the last
returns the packed pieces. ``run`` writes each stage's rows to shared storage and reads
them again, so that a stage starts from files and a lost executor costs a re-read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lectern.llm import lines, mixing, packing, similar, toxicity
from lectern.llm.queries import MIX_SEED, MIX_WEIGHTS, OTHER_WEIGHT, TOKENIZER, _learnable
from lectern.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content lines."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return lines.keep_content(docs, lines.sampled_field(docs, labels))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.learn(docs, _learnable(labels)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles, similarity 0.8), the one
    of the smallest id."""
    return similar.keep_one_of_similar(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated toward the sources' target weights, in shuffled order."""
    mixed = mixing.mixed(docs, MIX_WEIGHTS, OTHER_WEIGHT, seed=MIX_SEED)
    return mixed.drop("copy", "order_key")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.packed_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mixture),
    ("best_fit_packing", best_fit_packing),
]

#: Line labelling, scores and tokens are beyond SQL; tests compare stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
