"""An inverted index of names for similarity search without loss.

A name is found by q-grams with their places, rarest first. An edit changes q grams at most, so of two strings within d
edits each keeps all but q * d of its grams at places that differ by d or less; ordered alike, the first q * d + 1 grams
of both then share one such gram. q is the largest width at which no pair within the threshold can lose all its grams.
As similarity is relative to length, the keys of a string grow with its length and with nothing else.

The order of grams comes from counts in a table of fixed size (several grams may share a count: any order is right, a
better one is faster). The few grams that hold more than their share of the entries are dealt to blocks. All tables are
written once, with a fingerprint of the names and settings: a later run with the same ones reads them.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.scratch import delete_path

#: Counts of grams; their number bounds the table, whatever the names.
COUNTS = 1 << 13
#: Entries of a gram that make a block, and gram numbers beyond it: there are never more than MOST of them.
BLOCK, MOST = 1000, 50_000
WIDEST = 4
_SLACK = 1e-9
_VERSION = 1


def width(threshold: float, longest: int) -> int:
    """The largest q at which strings within the threshold keep a gram; longest: of the names."""
    for q in range(WIDEST, 1, -1):
        edits = ((m, int(m * (1 - threshold) + _SLACK)) for m in range(1, int(longest / threshold) + 2))
        if all(m - q + 1 > q * d for m, d in edits if d):
            return q
    return 1


@dataclass(frozen=True)
class Settings:
    threshold: float
    q: int
    longest: int
    n: int
    check: str
    version: int = _VERSION


class NameIndex:
    """The index of names (distinct name, id) at a path: tables names, entries, blocks and counts, and settings.json."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings):
        self.spark, self.path, self.settings = spark, path, settings
        self.names = spark.read.parquet(f"{path}/names")

    # -- storage

    @staticmethod
    def _file(spark: SparkSession, path: str):
        file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/settings.json")
        return file, file.getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def _stored(cls, spark: SparkSession, path: str) -> dict | None:
        file, system = cls._file(spark, path)
        if not system.exists(file):
            return None
        return json.loads("\n".join(r.value for r in spark.read.text(f"{path}/settings.json").collect()))

    @classmethod
    def of(cls, names: DataFrame, path: str, threshold: float) -> NameIndex:
        """The index of these (name, id) at the path: the stored one if it has the same names, ids and settings, else a new one."""
        spark = names.sparkSession
        one = names.where("name <> ''").groupBy("name").agg(F.min("id").alias("id"))
        n, longest, check = one.agg(F.count("*"), F.coalesce(F.max(F.length("name")), F.lit(0)), F.coalesce(F.sum(F.xxhash64("name", "id").cast("decimal(38,0)")), F.lit(0))).first()
        settings = Settings(threshold, width(threshold, longest), longest, n, str(check))
        if cls._stored(spark, path) != asdict(settings):
            delete_path(spark, path)
            one.write.parquet(f"{path}/names")
            cls(spark, path, settings)._build()
            file, system = cls._file(spark, path)
            with_settings = system.create(file, True)  # comes last: an index without it isn't whole
            with_settings.write(bytearray(json.dumps(asdict(settings)).encode()))
            with_settings.close()
        return cls(spark, path, settings)

    def _build(self) -> None:
        s = self.settings
        place = F.explode(F.sequence(F.lit(0), F.greatest(F.length("name") - s.q, F.lit(0))))
        grams = self.names.select("name", place.alias("pos")).select(self._slot(F.expr(f"substring(name, pos + 1, {s.q})")).alias("slot"))
        grams.groupBy("slot").agg(F.count("*").alias("n")).coalesce(1).write.parquet(f"{self.path}/counts")
        entries = self._keys(self.names.withColumn("text", F.col("name")), "name", "id")
        per = entries.groupBy("gram").agg(F.count("*").alias("n"))
        total = per.agg(F.sum("n")).first()[0] or 0
        share = max(BLOCK, total // MOST)
        per.where(F.col("n") > share).select("gram", F.ceil(F.col("n") / share).cast("int").alias("blocks")).coalesce(1).write.parquet(f"{self.path}/blocks")
        dealt = entries.join(F.broadcast(self.blocks()), "gram", "left").withColumn("block", F.pmod(F.xxhash64("name"), F.coalesce("blocks", F.lit(1))).cast("int"))
        dealt.select("gram", "block", "pos", "size", "name", "id").write.parquet(f"{self.path}/entries")

    def blocks(self) -> DataFrame:
        """(gram, blocks) of grams with more than a block of entries: MOST rows at most."""
        return self.spark.read.parquet(f"{self.path}/blocks")

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/entries")

    # -- keys

    @staticmethod
    def _slot(gram: Column) -> Column:
        return F.pmod(F.hash(gram), F.lit(COUNTS)).cast("int")

    def _edits(self, length: str) -> str:
        """SQL of the edits that strings may differ by, of which the longer one has this length."""
        return f"cast(floor({length} * {1 - self.settings.threshold!r}D + {_SLACK}D) AS int)"

    def _keys(self, rows: DataFrame, *keep: str) -> DataFrame:
        """(gram, pos, size, keep) of rows with a text: the grams that a similar string shares one of."""
        counts = [0] * COUNTS
        for r in self.spark.read.parquet(f"{self.path}/counts").collect():  # COUNTS rows at most
            counts[r.slot] = r.n
        q, threshold = self.settings.q, self.settings.threshold
        table = f"from_json('{json.dumps(counts, separators=(',', ':'))}', 'array<bigint>')"
        gram = f"substring(text, i + 1, {q})"
        ordered = f"sort_array(transform(sequence(0, size - {q}), i -> struct(get({table}, cast(pmod(hash({gram}), {COUNTS}) AS int)) AS n, {gram} AS gram, i AS pos)))"
        sized = rows.withColumn("size", F.length("text")).withColumn("most", F.expr(self._edits(f"floor(size / {threshold!r}D + {_SLACK}D)"))).where(f"most > 0 AND size >= {q}")
        first = sized.withColumn("key", F.explode(F.expr(f"slice({ordered}, 1, {q} * most + 1)")))
        return first.select("key.gram", "key.pos", "size", *keep)

    # -- search

    def exact(self, asked: DataFrame) -> DataFrame:
        """(input, id, score 1) of asked (input, form) rows whose form is a name."""
        return asked.join(self.names.withColumnRenamed("name", "form"), "form").select("input", "id", F.lit(1.0).alias("score"))

    def candidates(self, asked: DataFrame) -> DataFrame:
        """(input, form, name, id) of all pairs that may be within the threshold, some of them more than once."""
        s = self.settings
        within = asked.where(F.length("form") * s.threshold - _SLACK <= s.longest).withColumn("text", F.col("form"))
        keys = self._keys(within, "input", "form").withColumnsRenamed({"pos": "at", "size": "length"})
        dealt = keys.join(F.broadcast(self.blocks()), "gram", "left")
        probes = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        edits = self._edits("greatest(size, length)")
        near = F.expr(f"abs(pos - at) <= {edits} AND abs(size - length) <= {edits}")
        return probes.join(self.entries(), ["gram", "block"]).where(near).select("input", "form", "name", "id")

    def similar(self, asked: DataFrame) -> DataFrame:
        """(input, id, score) of the most similar name of each asked (input, form) at the threshold; ties: the smallest id."""
        near = self.candidates(asked).withColumn("score", T.similarity(F.col("form"), F.col("name"))).where(F.col("score") >= self.settings.threshold)
        return near.groupBy("input").agg(F.min(F.struct((-F.col("score")).alias("d"), "id")).alias("b")).select("input", F.col("b.id").alias("id"), (-F.col("b.d")).alias("score"))
