"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import re
import warnings
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from geolith.llm.queries import QUERIES
from tests.llm.test_operators import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        at = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(at)
        out.append((docs, spark.read.parquet(at)))
        docs = out[-1][1]
    return out


def test_stages_return_documents(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns
        ids = {r["doc_id"] for r in before.collect()}
        kept = [r["doc_id"] for r in after.collect()]
        assert len(kept) == len(set(kept)) and set(kept) <= ids and kept


def test_quality_stage_keeps_what_is_good(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[0][1].collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert np.mean([d in kept for d in good]) > 0.95


def test_near_stage_keeps_one_of_each_group(stages):
    before, after = stages[2]
    want = brute_components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {c for _, c in want.values()}


def test_packing_stage_holds_every_document(stages):
    before, after = stages[4]
    assert {r["doc_id"] for r in before.collect()} == {r["doc_id"] for r in after.collect()}


def test_run_is_the_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="targets out of reach")  # each language's tokens are within 1e-5 of their target
        got = corpus_pipeline.run(spark, SF).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[4][1].select(columns).collect()))


@pytest.fixture(scope="module")
def hard(spark):
    """Rows with nulls, empty and repeated texts and rows, and columns whose names operators might use."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "doc_id AS __id", "'x' AS __digest", "1 AS __n", "text AS ids", "'y' AS digest", "doc_id AS `key`", "0.5D AS score")
    some = rows.limit(40)
    return rows.union(some).union(some.withColumn("doc_id", F.lit(None).cast("long"))).union(some.withColumn("text", F.lit(None).cast("string"))).union(some.withColumn("lang", F.lit(None).cast("string")).withColumn("text", F.lit("")))


@pytest.mark.parametrize("k", range(4))
def test_stages_on_hard_rows(spark, hard, k):
    stage = corpus_pipeline.STAGES[k][1]
    got = stage(spark, hard, SF)
    assert got.schema == hard.schema
    kept, whole = Counter(map(tuple, got.collect())), Counter(map(tuple, hard.collect()))
    assert kept and all(n <= whole[row] for row, n in kept.items())  # rows stay as they are
    if k == 1:
        texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in got.collect()]
        assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in hard.collect()})
    assert stage(spark, hard.filter("false"), SF).count() == 0


def test_packing_stage_on_hard_rows(spark, hard):
    stage = corpus_pipeline.STAGES[4][1]
    got = stage(spark, hard, SF).groupBy("doc_id").agg(F.sum((F.col("piece") == 0).cast("int")).alias("n"))
    want = hard.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert stage(spark, hard.filter("false"), SF).count() == 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert name in entry.queries()
    rows = spark.read.parquet(f"{SF}/documents.parquet").count()
    if name == "op12_nearest_neighbours":  # ten for each query
        rows = 10 * spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id % 100 = 0").count()
    assert QUERIES[name](spark, SF).count() >= rows
