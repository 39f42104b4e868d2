"""Quality gates as rows of (item, status, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate(rows: DataFrame, item: str, passed: Column, detail: Column) -> DataFrame:
    """One row: the item passes if `passed`, an aggregate over all rows, is true."""
    return rows.agg(F.lit(item).alias("item"), F.when(passed, "PASS").otherwise("FAIL").alias("status"), detail.cast("string").alias("detail"))


def summary(gates: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, gates)


def missing_and_extra(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of one side alone, with side = missing or extra."""
    gone = expected.join(actual, keys, "left_anti").select(*keys).withColumn("side", F.lit("missing"))
    new = actual.join(expected, keys, "left_anti").select(*keys).withColumn("side", F.lit("extra"))
    return gone.unionByName(new)


def with_fallback(primary: DataFrame, others: list[DataFrame], key: str) -> DataFrame:
    """One row for each key, from the first source that has it; rank tells which."""
    ranked = reduce(DataFrame.unionByName, [s.withColumn("rank", F.lit(k)) for k, s in enumerate([primary, *others])])
    best = ranked.groupBy(key).agg(F.min(F.struct("rank", *[c for c in primary.columns if c != key])).alias("b"))
    return best.select(key, "b.*")
