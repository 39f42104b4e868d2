"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the normalised text. A batch is
reduced to one row per digest, met with the index in a sort-merge anti-join that leaves the index
side unshuffled, and what is new is appended to the index. Only digests are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geolith.llm.shared import BucketedTable, Scratch, documents, fresh_names

#: Each of these characters, alone or in a row, counts as one space.
WHITE = r"[\x20\x09-\x0D]+"


def text_digest(text: F.Column) -> F.Column:
    """SHA-256 of the normalised text as lowercase hex; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ").cast("binary"), 256)


class DigestIndex(BucketedTable):
    """The bucketed table of digests: digest, keep_id of the row that stays. Survives the session under `path`.

    Each batch adds a file to each bucket, which costs a sort of the bucket when it is read; compact() makes them one again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        super().__init__(spark, path, "digest STRING, keep_id BIGINT", "digest", buckets)


def exact_dedup(docs: DataFrame, index: DigestIndex, salts: int = 64) -> DataFrame:
    """Adds keep_id, group_size, kept and text_sha256 to (doc_id); appends new digests to the index.

    keep_id is the indexed row's doc_id for texts seen in an earlier batch, else the smallest doc_id
    of the batch. group_size counts the batch's rows with the text. Null text counts as empty; null
    doc_ids sort last and are dropped duplicates of any other; a repeated row with the smallest doc_id
    is kept each time, and so is a row that is fed again. A very long text is one string to the functions used. Empty
    input gives no rows. Other columns are ignored.
    A hot group is counted under (digest, salt of doc_id) before anything is keyed by digest alone.
    """
    spark = index.spark
    work = Scratch(spark, "exact_dedup")
    rows = work.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest")), "rows")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    parts = rows.groupBy("digest", "salt").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("digest")
    parts = work.table(
        parts.select("digest", "salt", F.min("first_id").over(whole).alias("batch_id"), F.sum("n").over(whole).alias("group_size"), F.row_number().over(whole.orderBy("salt")).alias("part")),
        "parts",
    )
    groups = parts.filter("part = 1").select("digest", F.col("batch_id").alias("keep_id"))
    new = work.table(groups.join(index.rows().hint("merge"), "digest", "left_anti"), "new")
    index.append(new.select("digest", "keep_id").repartition(index.buckets, "digest"))
    work.drop("new")
    resolved = parts.drop("part", "batch_id").join(index.rows().hint("merge"), "digest")
    return (
        rows.join(resolved.hint("merge"), ["digest", "salt"])
        .select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(False)).alias("kept"), F.col("digest").alias("text_sha256"))
    )


def drop_exact_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row for each normalised text, with all its columns; a repeated (doc_id, text) row stays once."""
    index = DigestIndex(spark, Scratch(spark, "digest_index").path("index"))
    key, digest = fresh_names(2)
    stay = exact_dedup(docs, index).filter("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(digest))
    keyed = docs.withColumns({key: F.col("doc_id").cast("long"), digest: text_digest(F.col("text"))})
    same = [keyed[key].eqNullSafe(stay[key]), keyed[digest] == stay[digest]]  # a null doc_id stays where no row of its text has another
    return keyed.join(stay.hint("merge"), same, "left_semi").dropDuplicates([key, digest]).select(*docs.columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, Scratch(spark, "digest_index").path("index"))
    return exact_dedup(documents(spark, sf_dir), index)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
