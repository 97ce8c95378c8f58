"""Exact deduplication by composable polynomial fingerprints.

Method: the fingerprint of a byte string is its value as a number in base 256 modulo a prime, with its length. The
fingerprint of a concatenation follows from those of its parts, fp(ab) = fp(a) * 256**len(b) + fp(b), so chunks of one
text are hashed apart and put together whatever the cuts. Huge texts are cut into chunks that several tasks hash; their
shifted hashes only have to be added up. Rows whose fingerprints are equal are then compared chunk by chunk in a sorted
stream: a chunk's smallest and largest bytes differ exactly where two texts differ. Should texts of one fingerprint
differ, their whole text becomes part of their key.

Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of equal texts the row with the
largest id stays; where several rows of a group carry that id, one of them stays. A row without id stays only in a group
without any id, whose keep_id is null. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_hot, rows_of

#: The largest prime below 2**120, so that fingerprints have two halves of 60 bits.
PRIME = (1 << 120) - 119
HALF = 60
#: Bytes hashed or compared at a time.
CHUNK = 1 << 16
#: Texts of more bytes are hashed by several tasks.
HUGE = 1 << 20

_KEY = ["hi", "lo", "n_bytes"]


class Fingerprint:
    """A byte string's value in base 256 modulo a prime, and its length; grows at its right end."""

    __slots__ = ("prime", "value", "length")

    def __init__(self, prime: int = PRIME, value: int = 0, length: int = 0):
        self.prime, self.value, self.length = prime, value, length

    @classmethod
    def of(cls, data: bytes, prime: int = PRIME) -> Fingerprint:
        return cls(prime, int.from_bytes(data, "big") % prime, len(data))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.prime, (self.shifted(other.length) + other.value) % self.prime, self.length + other.length)

    def shifted(self, by: int) -> int:
        """This part's share in the fingerprint of a whole in which `by` bytes follow it."""
        return self.value * pow(256, by, self.prime) % self.prime


def fingerprint(data: bytes, prime: int = PRIME, chunk: int = CHUNK) -> Fingerprint:
    whole = Fingerprint(prime)
    for start in range(0, len(data), chunk):
        whole += Fingerprint.of(data[start : start + chunk], prime)
    return whole


def _halves(value: int) -> tuple[int, int]:
    return value >> HALF, value & ((1 << HALF) - 1)


def _small(rows: DataFrame, prime: int) -> DataFrame:
    """(id, own, hi, lo, n_bytes, text_sha256) of rows whose texts one task hashes."""
    id_type = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, sizes, digests = [], [], [], []
            for (text,) in rows_of([batch], "text"):
                data = text.lower()  # of bytes: A-Z only
                whole = fingerprint(data, prime)
                high, low = _halves(whole.value)
                hi.append(high)
                lo.append(low)
                sizes.append(whole.length)
                digests.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["id", "own", *_KEY, "text_sha256"])

    return rows.select("id", "own", "text").mapInArrow(run, f"id {id_type.simpleString()}, own bigint, hi bigint, lo bigint, n_bytes bigint, text_sha256 string")


def _huge(rows: DataFrame, prime: int, chunk: int) -> DataFrame:
    """The same of huge texts: chunks are dealt to all tasks, hashed there, shifted by what follows them and added up."""
    kept = ["id", "own", "text_sha256", "n_bytes", "tag"]
    head = f"id {rows.schema['id'].dataType.simpleString()}, own bigint, text_sha256 string, n_bytes bigint"
    size = F.octet_length("text").cast("bigint")
    tagged = rows.select("id", "own", F.sha2(_lower("text"), 256).alias("text_sha256"), size.alias("n_bytes"), F.monotonically_increasing_id().alias("tag"), "text")
    cut = tagged.select(*kept, "text", F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1, F.lit(chunk).cast("bigint"))).alias("at"))
    chunks = cut.select(*kept, "at", F.substring("text", (F.col("at") + 1).cast("int"), F.lit(chunk)).alias("part")).repartition("tag", "at")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = [_halves(Fingerprint.of(part.lower(), prime).shifted(size - at - len(part))) for size, at, part in rows_of([batch], "n_bytes", "at", "part")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([h for h, _ in halves], pa.int64()), pa.array([x for _, x in halves], pa.int64())], [*kept, "hi", "lo"])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = [_halves(((int(high) << HALF) + int(rest)) % prime) for high, rest in rows_of([batch], "hi", "lo")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([h for h, _ in halves], pa.int64()), pa.array([x for _, x in halves], pa.int64())], [*kept[:4], "hi", "lo"])

    # Sums of 60-bit halves, taken apart, don't fit a long.
    wide = lambda name: F.sum(F.col(name).cast("decimal(20,0)")).alias(name)
    summed = chunks.mapInArrow(hashed, f"{head}, tag bigint, hi bigint, lo bigint").groupBy(*kept).agg(wide("hi"), wide("lo"))
    return summed.drop("tag").mapInArrow(reduced, f"{head}, hi bigint, lo bigint")


def _lower(binary: str) -> Column:
    return F.translate(F.col(binary).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, own, text): own hashes the text as it stands, so that a row without id is found again."""
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(F.col(key).alias("id"), F.xxhash64(data).alias("own"), data.alias("text"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", prime: int = PRIME, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """A row a document: id, own (a hash of its text as it stands), its fingerprint (hi, lo, n_bytes) and the sha256 of its lower-cased text."""
    rows = _rows(docs, key, text)
    large = F.octet_length("text") > huge
    return _small(rows.where(~large), prime).unionByName(_huge(rows.where(large), prime, chunk))


def _members(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(hi, lo, n_bytes, id, text) of the documents with a wanted (id, own, hi, lo, n_bytes)."""
    rows, wanted = _rows(docs, key, text), wanted.withColumnRenamed("id", "wanted_id")
    # Two texts of one id and one own hash would meet each other's fingerprints: whoever reads this looks at the text again.
    return rows.join(wanted.withColumnRenamed("own", "wanted_own"), (F.col("own") == F.col("wanted_own")) & F.col("id").eqNullSafe(F.col("wanted_id"))).select(*_KEY, "id", "text")


def _chunks(members: DataFrame, prime: int, chunk: int) -> DataFrame:
    """(hi, lo, n_bytes, at, part) of the lower-cased members whose text has the fingerprint that they met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("n_bytes", pa.int64()), ("at", pa.int64()), ("part", pa.binary())])
        for batch in batches:
            out, held = [], 0
            for hi, lo, size, text in rows_of([batch], *_KEY, "text"):
                if len(text) != size or fingerprint(data := text.lower(), prime).value != (hi << HALF) + lo:
                    continue
                for at in range(0, size, chunk):
                    out.append((hi, lo, size, at, data[at : at + chunk]))
                held += size
                if held > 8 << 20:
                    yield _batch(out, schema)
                    out, held = [], 0
            if out:
                yield _batch(out, schema)

    return members.select(*_KEY, "text").mapInArrow(run, "hi bigint, lo bigint, n_bytes bigint, at bigint, part binary")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema.names)


def _different(members: DataFrame, prime: int, chunk: int) -> DataFrame:
    """The fingerprints (hi, lo, n_bytes) that texts share which are not equal.

    Each task streams its chunks in the order of (fingerprint, place) and keeps the smallest and largest one seen, so
    a group of any size leaves a task as one row for each of its places.
    """
    parts = _chunks(members, prime, chunk).groupBy(*_KEY, "at").agg(F.min("part").alias("least"), F.max("part").alias("most"))
    return parts.where("least <> most").select(*_KEY).distinct()


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", prime: int = PRIME, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """A row a document: its id (named as key), keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "poly-dedup")
    rows = scratch.save(fingerprints(docs, key, text, prime, huge, chunk).groupBy(*_KEY, "id", "own").agg(F.count("*").alias("m"), F.min("text_sha256").alias("text_sha256")), "rows")
    ids = rows.groupBy(*_KEY, "id").agg(F.sum("m").alias("m"), F.min("text_sha256").alias("text_sha256"))
    classes = scratch.save(rows.groupBy(*_KEY).agg(F.max("id").alias("keep_id"), F.sum("m").alias("group_size")).where("group_size > 1"), "classes")
    counts, total = classes.select(*_KEY, F.col("group_size").alias("k")), rows.count()
    twice = join_hot(rows.select("id", "own", *_KEY), classes, _KEY, counts, total).where("group_size is not null")
    different = scratch.save(_different(_members(docs, twice.select("id", "own", *_KEY), key, text), prime, chunk), "different")
    if different.isEmpty():
        found = join_hot(ids, classes, _KEY, counts, total)
    else:
        apart = _told_apart(docs, rows.join(different, _KEY, "left_semi").select("id", "own", *_KEY), key, text, prime)
        found = join_hot(ids.join(different, _KEY, "left_anti"), classes, _KEY, counts, total).unionByName(apart)
    # Rows with equal id and text can't be told apart; the first of them stays.
    each = found.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))).alias("copy"))
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("id")).otherwise(F.col("keep_id"))
    return each.select(
        F.col("id").alias(key), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"), (single | (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))).alias("kept"), "text_sha256"
    )


def _told_apart(docs: DataFrame, wanted: DataFrame, key: str, text: str, prime: int) -> DataFrame:
    """Rows and classes of fingerprints that different texts share: the text itself is their key."""
    met = _members(docs, wanted, key, text)
    id_type = met.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, low = [], []
            for hi, lo, size, data in rows_of([batch], *_KEY, "text"):
                low.append(data.lower())
                keep.append(len(data) == size and fingerprint(low[-1], prime).value == (hi << HALF) + lo)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(low, pa.binary())], batch.schema.names).filter(pa.array(keep, pa.bool_()))

    texts = met.mapInArrow(run, f"hi bigint, lo bigint, n_bytes bigint, id {id_type}, text binary")
    counted = texts.groupBy(*_KEY, "text", "id").agg(F.count("*").alias("m"))
    classes = counted.groupBy("text").agg(F.max("id").alias("keep_id"), F.sum("m").alias("group_size"))
    return counted.join(classes, "text").select(*_KEY, "id", "m", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
