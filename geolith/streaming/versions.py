"""Batches of a stream written once: each has a path of its own, and counts when a ledger names it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


class VersionedTable:
    """Rows below `path`: batch=N holds batch N's, ledger has a row for each that counts, backup the rows that were there before the first overwriting.

    A batch that was written and not entered is overwritten when it is replayed; one that is in the ledger is left alone. So a failure
    at any place between leaves one copy.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def _there(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        return self._there("ledger", "batch LONG, whole BOOLEAN").groupBy("batch").agg(F.max("whole").alias("whole"))

    def has(self, batch: int) -> bool:
        return not self.ledger().filter(F.col("batch") == batch).isEmpty()

    def write(self, rows: DataFrame, batch: int, whole: bool = False, enter: Callable[[], None] | None = None) -> None:
        """Writes a batch, in place of all before it if `whole`, and enters it. `enter` stands in for the entering, in tests."""
        if self.has(batch):
            return
        if whole:
            self._back_up()
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        if enter:
            enter()
        # the ledger has few rows, one file each, named by the batch: entering twice changes nothing
        self.spark.createDataFrame([(batch, whole)], "batch LONG, whole BOOLEAN").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/entry-{batch}")

    def _back_up(self) -> None:
        """Keeps the rows of now, if no backup has been made: the first one wins, and a broken one is made anew."""
        if self._there("backup-done", "batch LONG").isEmpty() and not self.ledger().isEmpty():
            self.read().write.mode("overwrite").parquet(f"{self.path}/backup")
            self.spark.createDataFrame([(0,)], "batch LONG").write.mode("overwrite").parquet(f"{self.path}/backup-done")

    def backup(self) -> DataFrame:
        return self._there("backup", self.schema)

    def read(self) -> DataFrame:
        """The rows of all batches that count: from the last whole one on."""
        entries = {r["batch"]: r["whole"] for r in self.ledger().collect()}
        first = max((b for b, whole in entries.items() if whole), default=min(entries, default=0))
        parts = [f"{self.path}/batch={b}" for b in sorted(entries) if b >= first]
        return self.spark.read.schema(self.schema).parquet(*parts) if parts else self.spark.createDataFrame([], self.schema)


def append_batches(stream: DataFrame, table: VersionedTable, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> StreamingQuery:
    """Appends a stream's batches to the table, each once however often it is replayed; all there is now, then stops."""
    return stream.writeStream.foreachBatch(lambda rows, batch: table.write(change(rows), batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
