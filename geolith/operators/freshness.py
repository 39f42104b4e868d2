"""Which stages of a build are up to date, from a listing of their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, made, length) of the files below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("modificationTime").alias("made"), "length")


def stage_states(parts: DataFrame, slack: str = "INTERVAL 1 SECOND") -> DataFrame:
    """(stage, state) of (stage, role, made): the times at which a stage's inputs and outputs were made, null where a file is missing.

    A stage is fresh if all its outputs are there and none is older than its newest input, by more than the slack; else it is
    missing or stale. A stage without outputs only checks: its state is gate.
    """
    output, made = F.col("role") == "output", F.col("made")
    d = parts.groupBy("stage").agg(
        F.count(F.when(output, 1)).alias("outputs"), F.count(F.when(output & made.isNull(), 1)).alias("gone"), F.min(F.when(output, made)).alias("oldest"), F.max(F.when(~output, made)).alias("newest"),
    )
    late = F.col("oldest") < F.col("newest") - F.expr(slack)
    return d.select("stage", F.when(F.col("outputs") == 0, "gate").when(F.col("gone") > 0, "missing").when(late, "stale").otherwise("fresh").alias("state"))


def to_run(states: DataFrame, order: list[str], only: set[str] = frozenset(), first: str | None = None, skip: set[str] = frozenset(), force: bool = False) -> DataFrame:
    """(stage, state, runs) in the states of `order`: what is not fresh runs, with `force` all, of the stages asked for."""
    if unknown := ({first} if first else set()).union(only, skip) - set(order):
        raise ValueError(f"no such stage: {', '.join(sorted(unknown))}")
    asked = [s for s in order[order.index(first) if first else 0 :] if (not only or s in only) and s not in skip]
    return states.filter(F.col("stage").isin(order)).withColumn("runs", F.col("stage").isin(asked) & (F.lit(force) | (F.col("state") != "fresh")))
