"""Resolution of names to organisation identifiers. Every resolver gets distinct inputs."""

from __future__ import annotations

import json
import logging
import time
import urllib.error
import urllib.request
from abc import ABC, abstractmethod
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.scratch import Scratch
from .ledger import SHAPE as LEDGER_SHAPE
from .ledger import Ledger
from .name_index import NameIndex

log = logging.getLogger("metaenrich")


def input_key(text: Column) -> Column:
    """Stable key of an input."""
    return F.sha2(text, 256)


@dataclass(frozen=True)
class LookupConfig:
    service_url: str = "http://localhost:8000"
    registry: str | None = None
    batch_size: int = 50
    concurrency: int = 50
    timeout: int = 30
    attempts: int = 4
    pause: float = 0.5
    work_dir: str | None = None
    from_scratch: bool = False


class Resolver(ABC):
    def describe(self) -> str:
        """What decides its answers, as text; the state of a service is unknown to it."""
        return type(self).__name__

    @abstractmethod
    def resolve(self, inputs: DataFrame) -> DataFrame:
        """(input, id, score) of the inputs (distinct strings, column input) that have a match; one row each."""


class RegistryResolver(Resolver):
    """Matches against the registry's names: equal normalized forms, else the most similar name at the threshold.

    The names are looked up in an index (see NameIndex), which is written to `path` and read from there by later runs with
    the same names; without a path it is this resolver's own.
    """

    def __init__(self, registry: DataFrame, threshold: float = 0.9, path: str | None = None):
        self.registry, self.threshold = registry, threshold
        self._path, self._index = path, None

    def describe(self) -> str:
        return f"registry at {self.threshold!r}"

    def index(self) -> NameIndex:
        if self._index is None:
            names = self.registry.select("id", F.explode("names").alias("n")).select("id", T.normalize(F.col("n.value"), {}).alias("name"))
            path = self._path or Scratch(names.sparkSession, "names").path("index")
            self._index = NameIndex.of(names, path, self.threshold)
        return self._index

    def resolve(self, inputs: DataFrame) -> DataFrame:
        index = self.index()
        asked = inputs.withColumn("form", T.normalize(F.col("input"), {})).where("form <> ''")
        exact = index.exact(asked)
        if self.threshold >= 1.0:
            return exact
        return exact.union(index.similar(asked.join(exact, "input", "left_anti")))


class ServiceResolver(Resolver):
    """Asks a match service in batches: POST {task, inputs} to url/match, answered by [{input, id, score}].

    This wire format is this engine's own. At most `concurrency` requests run at a time in all: the inputs are dealt to
    that many tasks or fewer, which share the requests evenly. Inputs are asked in waves of some requests; a wave's
    answers are committed to a ledger before the next one begins, so a lost executor costs its part of a wave, and a run
    that is started again asks nothing that was answered. A failed request is repeated after a pause that doubles each
    time. If the service refuses it for good its batch is halved, until the inputs that it fails for are known; they are set aside in
    the ledger (asked again in a later run) and have no match.
    """

    #: Requests of a wave for each of those that run at a time.
    WAVE = 20

    def __init__(self, config: LookupConfig, task: str, ledger: str | None = None):
        self.config, self.task, self.path = config, task, ledger

    def describe(self) -> str:
        return f"{self.task} at {self.config.service_url}"

    def ledger(self, spark: SparkSession) -> Ledger:
        if self.path is None:
            self.path = Scratch(spark, "ledger").path("answers")
        return Ledger(spark, self.path)

    def resolve(self, inputs: DataFrame) -> DataFrame:
        spark = inputs.sparkSession
        ledger = self.ledger(spark)
        scratch = Scratch(spark, "asked")
        todo = scratch.save(ledger.open(inputs), "todo")
        waves = -(-todo.count() // (self.WAVE * max(1, self.config.concurrency) * self.config.batch_size))
        for wave in range(waves):
            ledger.commit(self._ask(todo.where(F.pmod(F.xxhash64("input"), F.lit(waves)) == wave)))
        asked = inputs.select("input").distinct()
        lost = asked.join(ledger.failed(), "input").count() if waves else 0
        if lost:
            log.warning("the match service failed for %d inputs; they have no match", lost)
        return asked.join(ledger.answered().where("id is not null").select("input", "id", "score"), "input")

    def _ask(self, inputs: DataFrame) -> DataFrame:
        """A ledger row for each input."""
        config, task = self.config, self.task
        tasks = max(1, min(config.concurrency, inputs.sparkSession.sparkContext.defaultParallelism))
        threads = max(1, config.concurrency // tasks)

        def request(batch: list[str]) -> list[dict]:
            body = json.dumps({"task": task, "inputs": batch}).encode()
            sent = urllib.request.Request(f"{config.service_url.rstrip('/')}/match", body, {"Content-Type": "application/json"})
            with urllib.request.urlopen(sent, timeout=config.timeout) as answer:
                return json.load(answer)

        def ask(batch: list[str], tries: int = 0) -> list[tuple]:
            for attempt in range(config.attempts):
                try:
                    found = {r["input"]: (r["id"], float(r.get("score", 1.0))) for r in request(batch) if r.get("id")}
                    return [(x, *found.get(x, (None, None)), None, tries + attempt + 1) for x in batch]
                except (OSError, ValueError, KeyError, TypeError, AttributeError) as error:  # no connection, no success, no answer in this format
                    said, refused = f"{type(error).__name__}: {error}", not isinstance(error, OSError) or isinstance(error, urllib.error.HTTPError)
                    if attempt + 1 < config.attempts:
                        time.sleep(config.pause * 2**attempt)
            tries += config.attempts
            if len(batch) == 1 or not refused:  # without a connection no part of the batch fares better
                return [(x, None, None, said, tries) for x in batch]
            half = len(batch) // 2
            return ask(batch[:half], tries) + ask(batch[half:], tries)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            with ThreadPoolExecutor(threads) as pool:
                for frame in frames:
                    values = frame["input"].tolist()
                    batches = [values[i : i + config.batch_size] for i in range(0, len(values), config.batch_size)]
                    yield pd.DataFrame([r for rows in pool.map(ask, batches) for r in rows], columns=["input", "id", "score", "error", "tries"])

        return inputs.select("input").repartition(tasks).mapInPandas(run, LEDGER_SHAPE)
