"""Deduplication, runs and offsets over ordered rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_of(rows: DataFrame, by: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_n = 1").drop("_n")


def numbered(rows: DataFrame, by: list[str], bucket: Column, order: list[Column | str], name: str) -> DataFrame:
    """rows with their number from 1 within the key, by `order`.

    bucket never falls along the order: rows are numbered within each (key, bucket), after the counts of those before, so that
    a key of many rows is no one task's.
    """
    parts = rows.withColumn("_b", bucket)
    before = exclusive_sum("_c", by, "_b")
    counts = parts.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c")).select(*[F.col(c).alias(f"_k{k}") for k, c in enumerate([*by, "_b"])], before.alias("_before"))
    own = F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order))
    same = [F.col(c).eqNullSafe(F.col(f"_k{k}")) for k, c in enumerate([*by, "_b"])]
    return parts.withColumn("_n", own).join(counts, same).select(*rows.columns, (F.col("_before") + F.col("_n")).alias(name))


def percentiles(rows: DataFrame, by: str, value: str, shares: list[float], width: float) -> DataFrame:
    """(by, p): the exact percentiles of the values of each key, with straight lines between neighbours.

    A first pass counts the values in buckets `width` wide, which tells the buckets that hold the wanted ranks; a second one takes the values of
    these alone, equal ones as one. So few values are shuffled, and no key's values meet in one task.
    """
    there = rows.filter(F.col(value).isNotNull()).select(by, value, F.floor(F.col(value) / width).alias("_b"))
    totals = there.groupBy(by, "_b").agg(F.count(F.lit(1)).alias("_s"))
    ahead = totals.select(by, "_b", "_s", exclusive_sum("_s", by, "_b").alias("_ahead"), F.sum("_s").over(Window.partitionBy(by)).alias("_all"))
    ranks = [f((F.col("_all") - 1) * F.lit(share)) for share in shares for f in (F.floor, F.ceil)]
    holds = reduce(lambda a, b: a | b, [(F.col("_ahead") <= r) & (r < F.col("_ahead") + F.col("_s")) for r in ranks])
    counts = there.join(ahead.filter(holds).drop("_s"), [by, "_b"]).groupBy(by, "_b", value, "_ahead", "_all").agg(F.count(F.lit(1)).alias("_c"))
    within = F.sum("_c").over(Window.partitionBy(by, "_b").orderBy(value))
    d = counts.withColumn("_end", F.col("_ahead") + within).withColumn("_start", F.col("_end") - F.col("_c"))
    found = []
    for k, share in enumerate(shares):
        place = (F.col("_all") - 1) * F.lit(share)
        at = lambda place: F.max(F.when((F.col("_start") <= place) & (place < F.col("_end")), F.col(value)))
        low, high, part = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
        found.append((low + (high - low) * part).alias(f"_p{k}"))
    return d.groupBy(by).agg(*found).select(by, F.array(*[f"_p{k}" for k in range(len(shares))]).alias("p"))


def exclusive_sum(value: str, by: str | list[str], order: str) -> Column:
    """Sum of the values before a row: offsets in a pool."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def longest_run(rows: DataFrame, by: str, place: str, gap: int = 2) -> DataFrame:
    """(by, start, finish): the run of places with steps of at most `gap` that spans most; the first of equals."""
    w = Window.partitionBy(by).orderBy(place)
    begun = rows.withColumn("_new", (F.coalesce(F.col(place) - F.lag(place).over(w), F.lit(gap + 1)) > gap).cast("int"))
    runs = begun.withColumn("_run", F.sum("_new").over(w)).groupBy(by, "_run").agg(F.min(place).alias("start"), F.max(place).alias("finish"))
    return first_of(runs, [by], [(F.col("start") - F.col("finish")), "start"]).select(by, "start", "finish")
