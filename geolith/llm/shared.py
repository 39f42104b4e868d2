"""Written tables in the cluster's shared folder, and set-up common to the operators here."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from geolith.session import importable as ready


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Only a local session may leave it unset; a folder of its own is then made and removed at exit.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="geolith-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextlib.contextmanager
def no_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files, which else stay until the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Of each nested use of scratch_scope, the scratch folders made in it.
_scopes: list[list[Scratch]] = []


@contextlib.contextmanager
def scratch_scope() -> Iterator[None]:
    """Removes the scratch folders that operators make meanwhile, once it is left.

    Results are read from these folders when they are asked for: write what is wanted before leaving.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for work in _scopes.pop():
            work.remove()


class Scratch:
    """Written Parquet tables of one operator call; they cut lineage and survive lost executors.

    They stay in the shared folder for as long as results may be read from them: until the scope that they are made in
    is left, or remove() is called.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        ready(spark)
        self.spark, self.at = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        if _scopes:
            _scopes[-1].append(self)

    def remove(self) -> None:
        self.drop("")

    def path(self, name: str) -> str:
        return f"{self.at}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and reads it again. Its shuffle files go as soon as it is written."""
        with no_shuffle_files(self.spark):
            df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Removes tables that nothing reads any more."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_names(n: int) -> list[str]:
    """Names for columns beside those of any table."""
    return [f"_{uuid.uuid4().hex}" for _ in range(n)]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class BucketedTable:
    """The table under `path`, bucketed and sorted by `key`, for this session.

    A new table gets as many buckets as asked for, or as the session has shuffle partitions. The number is
    written beside the rows, with the number of the generation of rows that counts: a table that is there keeps its own
    buckets, whatever later sessions ask for.
    """

    def __init__(self, spark: SparkSession, path: str, columns: str, key: str, buckets: int | None = None, compression: str = "zstd") -> None:
        self.spark, self.path, self.columns, self.key, self.compression = spark, path, columns, key, compression
        try:
            state = spark.read.parquet(f"{path}/buckets").orderBy("generation", ascending=False).first()
            self.buckets, generation = state["buckets"], state["generation"]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            self.buckets, generation = buckets or partitions(spark), 0
            self._count(generation)
        self._open(generation)

    def _count(self, generation: int) -> None:
        self.spark.createDataFrame([(self.buckets, generation)], "buckets int, generation int").write.mode("append").parquet(f"{self.path}/buckets")

    def _open(self, generation: int) -> None:
        self.generation, self.name = generation, f"bucketed_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}_{generation}"
        options = f"OPTIONS (compression '{self.compression}') CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows-{generation}'"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns}) USING parquet {options}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        """Adds rows that are dealt out by the key over as many partitions as there are buckets: a file for each bucket."""
        with no_shuffle_files(self.spark):
            rows.sortWithinPartitions(self.key).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def compact(self) -> None:
        """Writes the rows anew, one sorted file a bucket, and lets them count once they are there; then the old ones go."""
        old, before = self.generation, self.name
        # read as plain files: a scan by buckets would make the exchange look needless
        rows = self.spark.read.schema(self.rows().schema).parquet(f"{self.path}/rows-{old}").repartition(self.buckets, self.key)
        self._open(old + 1)
        self.append(rows)
        self._count(self.generation)
        self.spark.sql(f"DROP TABLE {before}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows-{old}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
