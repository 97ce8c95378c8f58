"""Stages of a lookup run, each with its Parquet result and marker in the work directory."""

from __future__ import annotations

import hashlib
from enum import Enum
from itertools import dropwhile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.method import EnrichmentMethod
from ..sources.scratch import tidy


class Stage(str, Enum):
    EXTRACT = "extract"
    QUERY = "query"
    RECONCILE = "reconcile"


class WorkDir:
    """Markers and tables in a directory of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _system(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def marker_path(self, stage: Stage) -> str:
        return f"{self.root}/{stage.value}.done"

    def is_complete(self, stage: Stage, state: str = "") -> bool:
        """Whether the stage was completed, from this state of its inputs if one is given."""
        marker = self._path(f"{stage.value}.done")
        if not self._system().exists(marker):
            return False
        return not state or [r.value for r in self.spark.read.text(self.marker_path(stage)).collect()] == [state]

    def mark(self, stage: Stage, state: str = "") -> None:
        """Sets the marker at once: it is written under another name before."""
        new, marker = self._path(f"{stage.value}.new"), self._path(f"{stage.value}.done")
        file = self._system().create(new, True)
        file.write(bytearray(state.encode()))
        file.close()
        self._system().delete(marker, False)
        if not self._system().rename(new, marker):
            raise OSError(f"{self.marker_path(stage)} can't be written")

    def unmark(self, stage: Stage) -> None:
        self._system().delete(self._path(f"{stage.value}.done"), False)

    def drop(self, name: str) -> None:
        self._system().delete(self._path(name), True)

    def remove(self) -> None:
        self._system().delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.root), True)

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        with tidy(self.spark):
            frame.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


def remaining(done: dict[Stage, bool], from_scratch: bool) -> list[Stage]:
    """All stages from scratch; else those from the first incomplete one on, marked or not."""
    return list(Stage) if from_scratch else list(dropwhile(lambda s: done[s], Stage))


def due_stages(done: dict[Stage, Column], from_scratch: Column) -> Column:
    """The same of many work directories, whose state is given by columns: the names of the stages that are due."""
    open_, out = from_scratch, []
    for stage in Stage:
        open_ = open_ | ~done[stage]
        out.append(F.when(open_, F.lit(stage.value)))
    return F.array_compact(F.array(*out))


def stages_to_run(work: WorkDir, from_scratch: bool, state: str = "") -> list[Stage]:
    """Stages completed from another state of the inputs count as incomplete."""
    return remaining({s: work.is_complete(s, state) for s in Stage}, from_scratch)


def state_of(method: EnrichmentMethod, files: DataFrame) -> str:
    """One line that changes with the corpus files (path, length, time), the method's settings and its registry."""
    each = F.xxhash64(*files.columns).cast("decimal(38,0)")
    n, check = files.agg(F.count("*"), F.coalesce(F.sum(each), F.lit(0))).first()
    return hashlib.sha256(f"{n} files {check}, {method.describe()}".encode()).hexdigest()


def run_stages(method: EnrichmentMethod, records: DataFrame, work: WorkDir, from_scratch: bool = False, only: Stage | None = None, state: str = "") -> DataFrame | None:
    """Parts of the reconciled records (prepared rows that are ok), or None if reconcile isn't due.

    A marker is set once its table is committed, and holds the state of the inputs that it was made from (see state_of).
    A single stage takes what the stages before it have left, whatever it was made from.
    """
    due = [only] if only else stages_to_run(work, from_scratch, state)
    for stage in due:
        work.unmark(stage)
    if from_scratch:
        work.drop("ledger")
    if Stage.EXTRACT in due:
        extracted = method.extract(records)
        work.save(extracted, "extracted")
        work.save(method.inputs(work.read("extracted")), "inputs")
        work.mark(Stage.EXTRACT, state)
    if Stage.QUERY in due:
        work.save(method.lookup(work.read("inputs")), "matches")
        work.mark(Stage.QUERY, state)
    if Stage.RECONCILE not in due:
        return None
    parts = work.save(method.map_back(work.read("extracted"), work.read("matches")), "parts")
    work.mark(Stage.RECONCILE, state)
    return parts
