"""Sharding by sampled splitters, with DataFrame operations only.

Method: rows are keyed by (hash of text, row), so equal texts stand side by side. Keys are sampled with probability in
proportion to size; their quantiles are the splitters of many fine ranges, and ranges with too many rows are subdivided.
Exact sizes of the ranges (a small table) then give each row its place on the line of all bytes, and so its shard.

Law `bytes`: sizes of the shards are near equal, and equal texts share a shard.
* Small groups of equal texts (up to SMALL of a shard) go where their middle lies on the line.
* Larger groups, at most n_shards / SMALL of them, are placed first, whole, each into the shard that is least full so
  far, the largest first; the line is then cut so that the shards fill up to one level.
* Only a group that is larger than a shard is cut, between rows; a row never is.
A shard so differs from that level by a small group at most, unless larger groups alone go beyond it.

Null text: no bytes, so size 16 and crc32 0. Doc_ids may be of any type, null and repeated. Repeated rows each get a
slot of their own. An empty table gives an empty result. Other columns are ignored by assign(), kept by write_shards().
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, locate

LAW = "bytes"
ROW_OVERHEAD = 16
#: Rows of a fine range aimed at, where the ranges are more than a few times the shards.
RANGE_ROWS = 50_000
#: Sampled keys a range; the sample and its splitters grow with the ranges, not with the rows of one.
SAMPLES_PER_RANGE = 40
MAX_RANGES = 16_384
#: Largest share of a shard that a group on the line may have.
SMALL = 0.01


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_OVERHEAD)


def _keys(docs: DataFrame, text: str, key: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), text_size(F.col(text)).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("h"), F.monotonically_increasing_id().alias("row"))


def packed(groups: list[tuple[int, int, int]], n_shards: int, rest: float) -> tuple[dict[int, int], list[float]]:
    """Shards of whole groups (hash, bytes, rows), and where the line of the `rest` bytes is cut.

    Largest first into the least full shard; the line then fills all shards up to one level.
    """
    full = [(0, s) for s in range(n_shards)]
    shard_of = {}
    for h, size, _ in sorted(groups, key=lambda g: (-g[1], g[0])):
        load, s = heapq.heappop(full)
        shard_of[h] = s
        heapq.heappush(full, (load + size, s))
    loads = [load for load, _ in sorted(full, key=lambda x: x[1])]
    level, left = 0.0, rest
    for i, load in enumerate(ordered := sorted(loads)):
        level = (sum(ordered[: i + 1]) + left) / (i + 1)
        if i + 1 == n_shards or level <= ordered[i + 1]:
            break
    cuts, at = [], 0.0
    for load in loads[:-1]:
        at += max(0.0, level - load)
        cuts.append(at)
    return shard_of, cuts


def assign(docs: DataFrame, n_shards: int = 40, text: str = "text", key: str = "doc_id", small: float = SMALL, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard (null: not this law)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    keys = scratch.save(_keys(docs, text, key), "keys")  # written, so that row numbers stay what they are
    total, rows = keys.agg(F.sum("size"), F.count("*")).first()
    total, rows = total or 0, rows or 0
    share = max(1.0, total / n_shards)

    # Groups beyond `small` of a shard: n_shards / small rows at most, whatever the input.
    sums = keys.groupBy("h").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where(F.col("bytes") > small * share)
    large = [(r.h, r.bytes, r.n) for r in sums.collect()]
    cut = {h for h, size, n in large if size > share and n > 1}
    whole = [g for g in large if g[0] not in cut]
    shard_of, cuts = packed(whole, n_shards, total - sum(g[1] for g in whole))

    # Size-weighted draw: the row's own hash decides, so a lost executor's rows are drawn alike again.
    n_ranges = max(1, min(MAX_RANGES, max(8 * n_shards, rows // range_rows), rows))
    known = spark.createDataFrame([(h, n_ranges + i, shard_of.get(h)) for i, (h, _, _) in enumerate(sorted(large))], "h bigint, own int, home int")
    ranged = keys.join(F.broadcast(known), "h", "left")
    chance = F.lit(n_ranges * SAMPLES_PER_RANGE / max(total, 1)) * F.col("size")
    drawn = ranged.where(F.col("own").isNull() & (F.pmod(F.xxhash64("row", "h", F.lit("draw")), F.lit(1 << 40)) < chance * F.lit(float(1 << 40))))
    quantiles = [i / n_ranges for i in range(1, n_ranges)]
    bounds = sorted(set(drawn.agg(F.percentile_approx("h", quantiles, 50_000)).first()[0] or [])) if quantiles else []
    ranged = ranged.withColumn("r", F.coalesce("own", locate(F.col("h"), bounds)))

    # Ranges with too many rows are subdivided: one of many texts by text, one of a single large group by row.
    aim = max(1, rows // n_ranges)
    load = ranged.groupBy("r").agg(F.count("*").alias("n")).where(F.col("n") > 2 * aim)
    load = load.select("r", F.ceil(F.col("n") / F.lit(aim)).alias("parts"))  # one row a range at most
    by = F.when(F.col("own").isNull(), F.xxhash64("h", F.lit("part"))).otherwise(F.xxhash64("row", F.lit("part")))
    split = ranged.join(F.broadcast(load), "r", "left").withColumn("q", F.coalesce(F.pmod(by, F.col("parts")), F.lit(0).cast("long"))).drop("own", "parts")

    # Where each part begins on the line: by range (a small table), then inside the range.
    on_line = split.where("home is null").groupBy("r", "q").agg(F.sum("size").alias("bytes"))
    by_range = on_line.groupBy("r").agg(F.sum("bytes").alias("all"))
    before_range = by_range.select("r", (F.sum("all").over(Window.orderBy("r")) - F.col("all")).alias("base"))
    inside = F.sum("bytes").over(Window.partitionBy("r").orderBy("q")) - F.col("bytes")
    line = on_line.withColumn("inside", inside).join(F.broadcast(before_range), "r").select("r", "q", (F.col("base") + F.col("inside")).alias("start"))

    part = Window.partitionBy("r", "q").orderBy("h", "row")
    placed = split.withColumn("in_bytes", F.coalesce(F.sum("size").over(part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("i", F.row_number().over(part))
    placed = placed.join(line, ["r", "q"], "left").withColumn("at", F.col("start") + F.col("in_bytes"))
    group = Window.partitionBy("r", "q", "h")
    placed = placed.withColumn("group_at", F.min("at").over(group)).withColumn("group_bytes", F.sum("size").over(group))
    # Twice the middle, so that all is whole numbers: of the group, or of the row of a group larger than a shard.
    middle = F.when(F.col("r") >= n_ranges, 2 * F.col("at") + F.col("size")).otherwise(2 * F.col("group_at") + F.col("group_bytes"))
    shard = F.coalesce(F.col("home"), locate(middle, [int(2 * c) for c in cuts]).cast("int"))
    placed = scratch.save(placed.select("doc_id", "size", "text_crc32", "r", "q", "i", shard.alias("shard")), "placed")
    scratch.drop("keys")

    # Slots: a part's rows of one shard are numbered after those of earlier parts. Parts are in order of the line, so
    # only a part that a cut divides has rows in several shards.
    counts = placed.groupBy("shard", "r", "q").agg(F.count("*").alias("n"), F.min("i").alias("first"))
    offset = counts.withColumn("offset", F.sum("n").over(Window.partitionBy("shard").orderBy("r", "q")) - F.col("n")).select("shard", "r", "q", "offset", "first")
    return placed.join(offset, ["shard", "r", "q"]).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("offset") + F.col("i") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, key: str = "doc_id") -> None:
    """Writes whole rows to path/shard=NN, in slot order within each file. `key` must identify a row."""
    placed = assign(docs, n_shards, key=key).select(F.col("doc_id").alias("__key"), F.col("shard").alias("__shard"), "slot")
    rows = docs.join(placed, docs[key].eqNullSafe(placed["__key"])).drop("__key")
    rows.repartition("__shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("__shard", "slot").withColumnRenamed("__shard", "shard").drop("slot").write.partitionBy("shard").parquet(path)
