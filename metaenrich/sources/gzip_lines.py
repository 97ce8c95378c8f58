"""Lines of gzip files and a verdict on each file, from one streaming pass.

Spark's reader hands over the packed bytes as they are, file by file and in order, from any store it can read: a codec
that passes bytes through keeps it from unpacking them (and from splitting a file). Tasks unpack them in bounded blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes unpacked at a time.
BLOCK = 1 << 20
#: Rows and bytes of a batch of lines.
_ROWS, _BYTES = 8192, 4 << 20
SHAPE = "value string, file struct<path: string, lines: bigint, damage: string>"
_FILE = pa.struct([("path", pa.string()), ("lines", pa.int64()), ("damage", pa.string())])
_CODEC, _EXTENSION = "org.apache.hadoop.io.compress.PassthroughCodec", "io.compress.passthrough.extension"


def as_it_is(suffix: str) -> dict[str, str]:
    """Options of a reader that gets the bytes of files with this suffix as they are, each file whole in one task."""
    return {"io.compression.codecs": _CODEC, _EXTENSION: suffix, f"org.apache.hadoop.shaded.{_EXTENSION}": suffix}  # the shaded client renames its setting


class Unpacker:
    """Unpacks the members of a gzip file, fed in pieces; holds no more than a block of unpacked bytes at a time."""

    def __init__(self, block: int = BLOCK):
        self.block, self.member, self.damage, self.started = block, None, None, False

    def feed(self, packed: bytes) -> Iterator[bytes]:
        """Unpacked blocks; nothing more once the file has proved damaged."""
        while packed and not self.damage:
            if self.member is None:
                packed = packed.lstrip(b"\0") if self.started else packed  # members may be padded with zeros
                if not packed:
                    return
                self.member, self.started = zlib.decompressobj(31), True
            try:
                out = self.member.decompress(packed, self.block)
            except zlib.error as error:
                self.damage = str(error)
                return
            if out:
                yield out
            packed = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if self.member.eof:
                self.member = None

    def end(self) -> str | None:
        """What is wrong with the file that ends here, or None."""
        if self.member is not None and not self.damage:
            self.damage = "cut short"
        return self.damage


class Lines:
    """Cuts blocks into lines. A last line without line feed counts; one that damage cuts off doesn't."""

    def __init__(self) -> None:
        self.begun: list[bytes] = []  # of the line that isn't complete yet
        self.count = 0

    def cut(self, block: bytes) -> list[bytes]:
        first, *others = block.split(b"\n")
        self.begun.append(first)
        if not others:
            return []
        out = [b"".join(self.begun), *others[:-1]]
        self.begun = [others[-1]] if others[-1] else []
        self.count += len(out)
        return out

    def rest(self) -> list[bytes]:
        out = [b"".join(self.begun)] if self.begun else []
        self.begun = []
        self.count += len(out)
        return out


class _File:
    """A file that is being read: its reader cut it at line feeds, which are part of the packed bytes."""

    def __init__(self, path: str, size: int, block: int):
        self.path, self.size, self.seen, self.pieces = path, size, 0, 0
        self.unpacker, self.lines = Unpacker(block), Lines()

    def take(self, pieces: list[bytes]) -> Iterator[list[bytes]]:
        packed = (b"\n" if self.pieces else b"") + b"\n".join(pieces)
        self.pieces += len(pieces)
        self.seen += len(packed)
        yield from map(self.lines.cut, self.unpacker.feed(packed))

    def finish(self) -> Iterator[list[bytes]]:
        if self.seen == self.size - 1:  # the last byte is a line feed
            self.seen += 1
            yield from map(self.lines.cut, self.unpacker.feed(b"\n"))
        damage = self.unpacker.end()
        if damage is None and self.seen != self.size:
            damage = self.unpacker.damage = "not read to its end"
        if damage is None:
            yield self.lines.rest()

    def verdict(self) -> dict:
        return {"path": self.path, "lines": self.lines.count, "damage": self.unpacker.damage}


def _rows(lines: list[bytes], verdict: dict | None = None) -> pa.RecordBatch:
    values = pa.array([*lines, *[None] * bool(verdict)], pa.binary())
    files = pa.array([None] * len(lines) + [verdict] * bool(verdict), _FILE)
    return pa.RecordBatch.from_arrays([values.view(pa.string()), files], ["value", "file"])  # bad UTF-8 stays as it is


def unpack(batches: Iterator[pa.RecordBatch], block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Batches of (path, size, piece), each file's pieces in a row, to batches of lines and, at each file's end, its verdict."""
    file: _File | None = None

    def packed(parts: Iterator[list[bytes]], verdict_of: _File | None = None) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for lines in parts:
            for start in range(0, len(lines), _ROWS):
                some = lines[start : start + _ROWS]
                held += some
                size += sum(map(len, some))
                if len(held) >= _ROWS or size >= _BYTES:
                    yield _rows(held)
                    held, size = [], 0
        if held or verdict_of:
            yield _rows(held, verdict_of and verdict_of.verdict())

    for batch in batches:
        pieces = batch.column(2)
        at = 0
        for (path, size), group in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            n = sum(1 for _ in group)
            if file is None or file.path != path:
                if file:
                    yield from packed(file.finish(), file)
                file = _File(path, size, block)
            for start in range(at, at + n, 1024):
                yield from packed(file.take(pieces.slice(start, min(1024, at + n - start)).to_pylist()))
            at += n
    if file:
        yield from packed(file.finish(), file)


def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes from start to end (exclusive) of a file that comes as (start, end, piece), its pieces cut at line feeds and in order."""
    at = 0
    for batch in batches:
        out = []
        for start, end, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at < end and at + len(piece) >= start:
                out.append(piece[max(0, start - at) : end - at])
            at += len(piece) + 1
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).view(pa.string())], ["value"])


def read_gzip_lines(spark: SparkSession, root: str, pattern: str, block: int = BLOCK) -> DataFrame:
    """(value, file): a row a line (file is null) and, after a file's lines, a row with its verdict (value is null).

    file.damage says what is wrong with a file: no gzip, damaged midway, cut short or not readable to its end; its lines
    up to there are given, not the one that the damage cuts off. Empty files have neither lines nor a verdict. A task
    holds a block of unpacked bytes, a batch of lines and the longest line, whatever the files' size.
    """
    pieces = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "\n").options(**as_it_is(".gz")).text(root)
    packed = pieces.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"))
    return packed.mapInArrow(lambda batches: unpack(batches, block), SHAPE)
