"""A ledger of requests to a match service: what was answered is kept, what failed is set aside."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import delete_path

SHAPE = "input string, id string, score double, error string, tries int"


class Ledger:
    """Answers in a folder that driver and executors share: one committed table a wave of requests.

    A wave counts once its table is committed; what a broken-off wave has left behind is neither read nor in the way.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _waves(self) -> list[str]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        done = lambda s: s.isDirectory() and system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        return sorted(s.getPath().toString() for s in system.listStatus(folder) if done(s))

    def rows(self) -> DataFrame:
        """(input, id, score, error, tries) of all committed waves; an input that failed before may have several rows."""
        waves = self._waves()
        return self.spark.read.schema(SHAPE).parquet(*waves) if waves else self.spark.createDataFrame([], SHAPE)

    def answered(self) -> DataFrame:
        """Rows of the inputs that the service has answered, with a match (id) or without."""
        return self.rows().where("error is null")

    def failed(self) -> DataFrame:
        """(input, error, tries) of inputs without an answer so far: the last failure, and all tries."""
        bad = self.rows().join(self.answered().select("input"), "input", "left_anti")
        return bad.groupBy("input").agg(F.max("error").alias("error"), F.sum("tries").alias("tries"))

    def open(self, inputs: DataFrame) -> DataFrame:
        """Distinct inputs that have no answer."""
        return inputs.select("input").where("input is not null").distinct().join(self.answered().select("input"), "input", "left_anti")

    def commit(self, wave: DataFrame) -> None:
        wave.write.parquet(f"{self.path}/{uuid.uuid4().hex}")

    def clear(self) -> None:
        delete_path(self.spark, self.path)
