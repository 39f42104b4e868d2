"""The relational tables and the relations that queries derive from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Events as a raster of 30 days (rows) by 24 hours (columns).
DAYS, HOURS = 30, 24


def event_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(i, j, z): mean value of each day and hour."""
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")) % DAYS
    return table(spark, sf_dir, "events").groupBy(day.alias("i"), F.hour("ts").alias("j")).agg(F.round(F.avg("value"), 4).alias("z"))


RASTER_SQL = "raster AS (SELECT (date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) % 30)::INT AS i, hour(ts)::INT AS j, round(avg(value), 4) AS z FROM events GROUP BY 1, 2)"


def vector_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, x, y, src): points on a plane of about 100 units, from three sources."""
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", (e[0].cast("double") * 100).alias("x"), (e[1].cast("double") * 100).alias("y"), (F.col("label") % 3).alias("src"))


POINTS_SQL = "points AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 100 AS x, CAST(embedding[2] AS DOUBLE) * 100 AS y, label % 3 AS src FROM embeddings)"


def part_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, ring, heading): rectangles whose size and turn follow from the part; a few are degenerate."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("w"), (F.col("p_partkey") % 40).cast("double").alias("h"), ((F.col("p_partkey") * 37) % 360).cast("double").alias("heading"))
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    zero = F.lit(0.0)
    return p.select("p_partkey", F.array(corner(zero, zero), corner(F.col("w"), zero), corner(F.col("w"), F.col("h")), corner(zero, F.col("h"))).alias("ring"), "w", "h", "heading")
