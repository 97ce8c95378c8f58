"""Organisation registry: a JSON dump of organisations with names and external identifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .gzip_lines import as_it_is

SCHEMA = "id string, names array<struct<value: string, types: array<string>>>, external_ids array<struct<type: string, all: array<string>, preferred: string>>, status string"
_MARK = re.compile(rb'["{}\[\]]')
_REST_OF_STRING = re.compile(rb'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)


class Objects:
    """Finds the borders of the objects of a dump, a list or one object after the other, in text that comes in pieces."""

    def __init__(self) -> None:
        self.depth = self.level = 0  # level: depth at which the objects stand
        self.in_string = self.inside = False
        self.held: list[bytes] = []

    def feed(self, piece: bytes) -> Iterator[bytes]:
        at = start = 0
        while True:
            if self.in_string:
                match = _REST_OF_STRING.match(piece, at)
                if match is None:
                    break
                at, self.in_string = match.end(), False
                continue
            match = _MARK.search(piece, at)
            if match is None:
                break
            mark, at = match[0], match.end()
            if mark == b'"':
                self.in_string = True
            elif mark in b"{[":
                if not self.inside and mark == b"[" and not self.depth:
                    self.level = 1
                elif not self.inside and mark == b"{" and self.depth == self.level:
                    self.inside, start = True, match.start()
                self.depth += 1
            else:
                self.depth -= 1
                if self.inside and self.depth == self.level:
                    yield b"".join([*self.held, piece[start:at]])
                    self.held, self.inside = [], False
        if self.inside:
            self.held.append(piece[start:])


def _objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (path, piece), where each piece but the last ended with a brace, to the texts of the dump's objects."""
    path, scanner, first = None, Objects(), True
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            out = []
            for own, piece in zip(batch.column(0).slice(start, 1024).to_pylist(), batch.column(1).slice(start, 1024).to_pylist(), strict=True):
                if own != path:
                    out += scanner.feed(b"}") if scanner.inside else []
                    path, scanner, first = own, Objects(), True
                out += scanner.feed(piece if first else b"}" + piece)
                first = False
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).view(pa.string())], ["value"])
    if scanner.inside:
        yield pa.RecordBatch.from_arrays([pa.array(list(scanner.feed(b"}")), pa.binary()).view(pa.string())], ["value"])


def read_objects(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """(value): the texts of a dump's objects, dealt to all tasks.

    One task passes over a file, cut at closing braces whatever the lines, and holds one object at a time; parsing is for
    those who get the objects. suffix: of the files in a folder; by default the path's own, or else .json.
    """
    suffix = suffix or PurePosixPath(path).suffix or ".json"
    pieces = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").options(**as_it_is(suffix)).text(path)
    found = pieces.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece")).mapInArrow(_objects, "value string")
    return found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_registry(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """(id, name, names, external_ids): the display name, or else the first one. What isn't an object with an id is left out."""
    orgs = read_objects(spark, path, suffix).select(F.from_json("value", SCHEMA).alias("o")).select("o.*").where("id is not null")
    shown = F.filter("names", lambda n: F.coalesce(F.array_contains(n["types"], "ror_display"), F.lit(False)))
    return orgs.select("id", F.coalesce(F.get(shown, F.lit(0))["value"], F.get("names", F.lit(0))["value"]).alias("name"), "names", "external_ids")


def crosswalk(registry: DataFrame, kind: str = "fundref") -> DataFrame:
    """(external_id, id): identifiers of another registry to this one's."""
    each = registry.select("id", F.explode("external_ids").alias("x")).where(F.lower("x.type") == kind)
    return each.select(F.explode(F.array_union(F.coalesce("x.all", F.array().cast("array<string>")), F.filter(F.array("x.preferred"), lambda v: v.isNotNull()))).alias("external_id"), "id").distinct()
