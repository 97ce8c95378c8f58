"""Centroid clustering by delta Lloyd, in whole numbers.

Method: the assignment of each vector (owner and distance) and the global sums of each centroid persist from round to
round. A round compares a vector only with the centroids that changed, unless its own centroid moved: then with all of
them. The vectors that changed their owner give signed integer transfers, plus to the new one and minus to the old one,
which are added to the sums; no other vector is looked at for the new centroids.

A vector takes part if it has exactly `dims` components, none of them null or not finite; the others are left out of the
result. Component x counts as floor(scale * x). Ties in distance go to the smaller centroid number. Each row is a vector
of its own, also with a repeated or null id; rows without id come last in the order that chooses the first centroids, and
rows of equal id there in the order of their components. With fewer than k vectors there are as many centroids as
vectors, an empty table gives an empty result. Other columns are ignored. Components beyond LIMIT, whose squares no long
could add up, are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LIMIT = 1 << 27
_STATE = "v array<int>, owner int, distance bigint, previous int"


@dataclass(frozen=True)
class Clustering:
    """assigned: (id, v, owner, distance, previous) a vector; centroids by number; rounds: (changed centroids, moved vectors) of each."""

    assigned: DataFrame
    centroids: tuple[tuple[int, ...], ...]
    rounds: tuple[tuple[int, int], ...]


def whole_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 1024) -> DataFrame:
    """(id, v) of the rows that take part."""
    x = F.transform(vector, lambda e: e.cast("double"))
    usable = (F.size(vector) == dims) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform(x, lambda e: F.floor(e * scale))
    outside = F.exists(x, lambda e: F.abs(e * scale) > LIMIT)
    checked = F.when(outside, F.raise_error(F.lit(f"a component is beyond {LIMIT} / {scale}")).cast("array<int>")).otherwise(whole.cast("array<int>"))
    return rows.where(F.coalesce(usable, F.lit(False))).select(F.col(key).alias("id"), checked.alias("v"))


def _components(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, a row each, as 64-bit integers."""
    flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1).astype(np.int64)


def _compare(state: DataFrame, centroids: list[tuple[int, ...]], changed: list[int]) -> DataFrame:
    """The state after every vector has met the changed centroids, or all of them if its own one is among those."""
    id_type, moving = state.schema["id"].dataType.simpleString(), set(changed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(centroids, np.int64)
        changed_now = np.array([c in moving for c in range(len(table))] + [True])  # the last one: no owner yet
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _components(batch)
            previous = batch.column(2).to_numpy()
            stale = changed_now[previous]
            best = np.where(stale, np.iinfo(np.int64).max, batch.column(3).to_numpy())
            owner = np.where(stale, len(table), previous)
            for c in range(len(table)):
                rows = slice(None) if c in moving else np.flatnonzero(stale)
                gap = v[rows] - table[c]
                far = np.einsum("ij,ij->i", gap, gap)
                closer = (far < best[rows]) | (far == best[rows]) & (c < owner[rows])
                best[rows] = np.where(closer, far, best[rows])
                owner[rows] = np.where(closer, c, owner[rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(owner, pa.int32()), pa.array(best, pa.int64()), pa.array(previous, pa.int32())], batch.schema.names)

    return state.mapInArrow(run, f"id {id_type}, {_STATE}")


def _transfers(state: DataFrame, k: int, dims: int) -> list[list[int]]:
    """By centroid: the change of its count and sums, signed, from the vectors that changed their owner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, dims + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                v = np.column_stack([np.ones(batch.num_rows, np.int64), _components(batch)])
                for sign, column in ((1, "owner"), (-1, "previous")):
                    owners = batch.column(batch.schema.get_field_index(column)).to_numpy()
                    for c in np.unique(owners):
                        total[c] += sign * v[owners == c].sum(axis=0)
        moved = [c for c in range(k) if total[c].any()]
        yield pa.RecordBatch.from_arrays([pa.array(moved, pa.int32()), pa.array([total[c].tolist() for c in moved], pa.list_(pa.int64()))], ["c", "part"])

    parts = state.where("owner <> previous").select("v", "owner", "previous").mapInArrow(run, "c int, part array<bigint>")
    added = parts.select("c", F.posexplode("part").alias("i", "x")).groupBy("c", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = [[0] * (dims + 1) for _ in range(k)]
    for c, i, x in added.collect():  # k * (dims + 1) numbers at most
        out[c][i] = int(x)
    return out


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3:") -> Clustering:
    """k-means of whole-number vectors: `rounds` rounds, then one more assignment.

    The first centroids are the k vectors with the smallest sha256 of seed and id. The state of a round is a table in the
    shared folder, so a lost executor costs its tasks and no earlier round.
    """
    scratch = Scratch(rows.sparkSession, "delta-lloyd")
    vectors = whole_vectors(rows, key, vector, dims, scale)
    order = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = vectors.withColumn("h", order).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    centroids = [tuple(r.v) for r in first]
    k = len(centroids)
    state = scratch.save(vectors.selectExpr("id", "v", f"{k} as owner", "0L as distance", f"{k} as previous"), "round0")
    if not k:
        return Clustering(state, (), ())
    sums, log = [[0] * (dims + 1) for _ in range(k)], []
    changed = list(range(k))
    for r in range(1, rounds + 2):
        if not changed:
            break
        state = scratch.save(_compare(state, centroids, changed), f"round{r}")
        scratch.drop(f"round{r - 1}")
        if r > rounds:
            break
        delta = _transfers(state, k, dims)
        sums = [[a + b for a, b in zip(s, d, strict=True)] for s, d in zip(sums, delta, strict=True)]
        after = [tuple(x // n for x in s) if n else old for (n, *s), old in zip(sums, centroids, strict=True)]
        changed = [c for c in range(k) if after[c] != centroids[c]]
        log.append((len(changed), sum(max(d[0], 0) for d in delta)))
        centroids = after
    return Clustering(state, tuple(centroids), tuple(log))


def digest(found: Clustering, key: str = "vec_id") -> DataFrame:
    """A row a vector: id (named as key), cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    state = found.assigned
    if not found.centroids:
        return state.selectExpr(f"id as `{key}`", "owner as cluster", "distance", "distance as cluster_inertia", "distance as inertia", "cast(null as string) as centroid_sha256")
    inertia = {r.owner: int(r.s) for r in state.groupBy("owner").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a number for each centroid
    per = F.array(*[F.lit(inertia.get(c, 0)).cast("bigint") for c in range(len(found.centroids))])
    named = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in found.centroids])
    return state.select(
        F.col("id").alias(key), F.col("owner").alias("cluster"), "distance", per[F.col("owner")].alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), named[F.col("owner")].alias("centroid_sha256")
    )
