"""Quality classifier on supervised subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolith.llm.kernels import blocks
from geolith.llm.shared import documents, ready
from geolith.llm.subwords import Settings, class_scores, train

SETTINGS = Settings()


def held_out(doc_id: F.Column) -> F.Column:
    """Whether crc32 of doc_id as text leaves the remainder 1 by 3; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> np.ndarray:
    """Learns labels.quality from rows that are not held out."""
    known = labels.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    return train(docs, known, 2, settings)


def with_scores(docs: DataFrame, table: np.ndarray, settings: Settings = SETTINGS) -> DataFrame:
    """(doc_id, score): the probability of label 1 for each row's whole text.

    Null text counts as empty; empty texts, and all texts if there were no labels, score 0.5. Rows are scored
    one by one: repeated and null doc_ids keep their rows. A very long text is scored whole, in about 60 bytes of a task's memory for each of its
    own. Other columns are ignored.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            for first, texts in blocks(batch["text"]):
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(texts)), pa.array(class_scores(texts, shared.value, settings)[:, 1])], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = with_scores(docs, quality_model(docs, documents(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """The rows of docs that score 0.5 or more, with all their columns, in one pass over them.

    Texts without evidence (null, empty, or no labels at all) score 0.5 and stay. A very long text is scored whole, as in with_scores.
    """
    table = spark.sparkContext.broadcast(quality_model(docs, labels, settings))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [class_scores(texts, table.value, settings)[:, 1] >= 0.5 for _, texts in blocks(batch["text"])]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(keep, docs.schema)
