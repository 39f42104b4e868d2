"""What a session needs: workers that find this package, and written tables that cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package when the driver found it beside its own script."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session that has none gets one of its own, removed at exit."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="geolith-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Rounds:
    """The table of an iteration, written as Parquet in each round and read again: lineage ends there, and lost executors lose nothing.

    Repeated shapes make files that are a small part of their rows in memory, so their size is no reason to broadcast a table: joins of one sort and merge.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.at, self.n = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0

    def write(self, df: DataFrame, last: int = 1) -> DataFrame:
        """Of earlier tables, the `last` ones stay."""
        self.n += 1
        df.write.option("compression", "zstd").parquet(f"{self.at}/{self.n}")
        if self.n > last:
            jvm = self.spark._jvm
            old = jvm.org.apache.hadoop.fs.Path(f"{self.at}/{self.n - last}")
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
        return self.spark.read.schema(df.schema).parquet(f"{self.at}/{self.n}").hint("merge")
