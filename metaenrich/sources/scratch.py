"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Only a local master, as in tests, may go without one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if "dir" not in _LOCAL:
            _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="metaenrich-")
        found = _LOCAL["dir"]
    return found.rstrip("/")


_LOCAL: dict[str, str] = {}
#: Folders of queries whose results may still be read, with their sessions.
_OPEN: dict[str, SparkSession] = {}
#: Spark deletes a statement's shuffle files at its end when this is set.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Statements in here run with this setting."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def tidy(spark: SparkSession):
    """Statements in here delete their shuffle files when they end."""
    return setting(spark, _CLEANUP, "true")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly to all tasks, before costly work: a gzip file or a table of few row groups is read by few."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch() -> None:
    """Deletes the tables of all queries so far: for long sessions, once their results are written. Also done at exit."""
    while _OPEN:
        root, spark = _OPEN.popitem()
        try:
            delete_path(spark, root)
        except Exception:  # noqa: BLE001  the session may be gone by now, with its folder
            pass


atexit.register(clear_scratch)


class Scratch:
    """Parquet tables of one query in the shared folder.

    A table that a returned (lazy) frame still reads must outlive the query, so those stay until clear_scratch();
    drop() removes a table as soon as no later step reads it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/metaenrich-{name}-{uuid.uuid4().hex}"
        _OPEN[self.root] = spark

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def file_system(self):
        """The folder's Hadoop file system, and a function that makes its path of a name."""
        path = lambda name: self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path("").getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        """Writes the frame and reads it again; the shuffle files of this step go as soon as it is written."""
        with tidy(self.spark):
            frame.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, self.path(name))
