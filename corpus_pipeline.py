"""From raw documents to packed sequences, in five stages of the subpackage llm.

Each stage takes what its predecessor kept; run() writes that as Parquet and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm import exact_dedup, mixing, near_dedup, packing, quality
from geolith.llm.shared import Scratch, documents, scratch_scope

#: Target weights of the languages' tokens, near what the corpus has; no document is repeated.
WEIGHTS = {"de": 0.15, "en": 0.6, "es": 0.1, "fr": 0.15}


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_quality(spark, docs, documents(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact_dedup.drop_exact_copies(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_copies(docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay with the chance that brings their languages to WEIGHTS."""
    return mixing.mix(docs, docs.select("doc_id", F.col("lang").alias("domain")), WEIGHTS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their places in sequences of 1024 tokens."""
    return packing.pack(spark, docs, packing.default_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("mixing sources to target weights", mixing_to_weights),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Between stages one written table is kept, and nothing else that stages wrote.

    Null and empty texts go through all stages as empty ones; rows with a null doc_id end with the near-copies stage; repeated rows
    become one in the exact-copies stage. Further columns of documents stay until the last stage. An empty table gives no rows.
    """
    docs = documents(spark, sf_dir)
    work = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with scratch_scope():
            docs = work.table(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            work.drop(f"stage-{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the learned stages; tests hold the stages against brute force.
ORACLE_SQL = None
