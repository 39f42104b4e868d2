"""Resumable work as a stream: events of tiles update a ledger, features are kept once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geolith.operators.ranking import first_of

EVENTS = "tile STRING, status STRING, n INT, at TIMESTAMP"


def last_status(events: DataFrame) -> DataFrame:
    """The last event of each tile."""
    return first_of(events, ["tile"], [F.desc("at"), F.desc("status")])


def pending(tiles: DataFrame, ledger: DataFrame) -> DataFrame:
    """Tiles without a last status of done or split."""
    return tiles.join(last_status(ledger).filter(F.col("status").isin("done", "split")).select("tile"), "tile", "left_anti")


def append_new(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: str, at: str, delay: str = "1 hour") -> StreamingQuery:
    """Appends rows of JSON files in `source` to `target`, each key once within the watermark; all files there now, then stops."""
    rows = spark.readStream.schema(schema).json(source).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Events of each status and time window; works on a stream as on a table."""
    return events.withWatermark("at", delay).groupBy(F.window("at", size), "status").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("features"))
