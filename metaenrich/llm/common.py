"""What several corpus operators share: tables, scratch storage and word hashing."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import Scratch, clear_scratch, delete_path, shared_dir, tidy

__all__ = ["Scratch", "clear_scratch", "delete_path", "shared_dir", "tidy"]

MASK64 = (1 << 64) - 1
#: Odd multiplier of the rolling hashes, and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def locate(key: Column, bounds: list[int]) -> Column:
    """Number of bounds (ascending) at or below key, by a two-level search: about 2 * sqrt(len(bounds)) comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    literal = lambda values: F.array(*map(F.lit, values)) if len(values) < 64 else F.from_json(F.lit(str(values)), "array<bigint>")
    first = F.size(F.filter(literal(bounds[step - 1 :: step]), lambda b: b <= key)) * F.lit(step)
    return first + F.size(F.filter(F.slice(literal(bounds), first + 1, F.lit(step)), lambda b: b <= key))


#: A key with more than 1 / HOT of all rows is hot; there are fewer than HOT of them.
HOT = 10_000


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], counts: DataFrame, total: int) -> DataFrame:
    """rows left-joined with a table that has a row a key; hot keys' rows stay where they are.

    counts (keys, k) tells how many rows a key has; the table's rows of the fewer than HOT hot keys are broadcast, only
    the others are dealt by key.
    """
    hot = F.broadcast(table.join(counts.where(F.col("k") > total / HOT).select(*keys), keys, "left_semi").withColumn("__hot", F.lit(True)))
    first = rows.join(hot, keys, "left")
    rest = first.where("__hot is null").select(*rows.columns).join(table, keys, "left")
    return first.where("__hot").drop("__hot").union(rest.select(*[c for c in first.columns if c != "__hot"]))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Powers:
    """Powers of BASE and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            steps = np.full(size, BASE), np.full(size, BASE_INV)
            steps[0][0] = steps[1][0] = np.uint64(1)
            self.up, self.down = np.cumprod(steps[0]), np.cumprod(steps[1])
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` consecutive values, in order of their start; empty if there are too few."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = _POWERS.get(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(hashes * up, out=sums[1:])
    return mix64((sums[width:] - sums[:-width]) * down[: n - width + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of `width` values, by doubling."""
    if len(values) < width:
        return np.empty(0, values.dtype)
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def as_signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def rows_of(batches: Iterable, *names: str):
    """Python tuples of the named columns of Arrow batches, with a small number of rows alive at a time."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for start in range(0, batch.num_rows, 512):
            yield from zip(*(c.slice(start, 512).to_pylist() for c in columns), strict=True)
