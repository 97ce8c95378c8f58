"""Removal of repeated passages with a log-structured fingerprint index.

A window is WIDTH consecutive words of one document; a word goes if a window that covers it also starts anywhere
else, in the same document included. Windows are judged on all that the index holds.

Method: FingerprintIndex lives in a folder and outlasts its session; a manifest there names its tables. Batches of
documents are added one after the other. For each batch:
1. Every window is filed under one fingerprint: the smallest hash of the GRAM-word runs inside it. Equal windows have
   equal fingerprints, and neighbouring windows mostly share theirs, so a document has about one for 14 windows.
2. The batch's fingerprints become an immutable run, sorted and bucketed by fingerprint, which is merge-joined with the
   runs of history, bucket by bucket, without moving history again. Fingerprints that now occur twice are candidates. A
   run names the text of a fingerprint that occurs once, so that an old text is woken when a new one meets it.
3. Candidates are verified: the windows of the texts under them become a run of window hashes (128 bits: fingerprint and
   a hash of all WIDTH words), merge-joined with those of history. A window that occurs twice is a repeat. Each text's
   windows under a fingerprint are looked at once, in the batch in which they become candidates. Of an older batch's
   texts only the keys are read, and then the files that hold a woken one.
4. Beyond FAN_IN runs of a kind, the newest ones are compacted into one, as long as the next older run holds at most
   TIER times the bytes of those (or is small anyway). So a large run is written again only once the newer ones have grown near its size: the
   runs are few (their sizes fall by more than TIER), and a hash is rewritten a logarithmic number of times.

A batch counts once its manifest stands: a file of its own number, written aside and renamed. The newest whole manifest
is the state, so whatever a lost session left is ignored and the batch can be added again. A folder with tables but without a
manifest, or with another number of buckets than asked for, is refused. One writer at a time.

Counts are pre-aggregated before each shuffle, so a passage that a third of all documents holds costs each task one row.
Equal word sequences are one text: the first copy in a task carries it, and a text of WIDTH words or more that occurs
twice goes as a whole. Rows of texts with so many copies that only HOT of them can exist are told apart by a broadcast of
these few before rows meet the verdicts of their texts. remove_repeats() files a table in BATCHES, by hash of the words,
so that copies come together.

Null and empty texts have no words: nothing removed. Repeated rows are copies of each other. A row without doc_id
is counted like any other, and treated alike. Columns other than key and text are ignored; an empty table gives an
empty result. Texts of any length are taken whole.
"""

from __future__ import annotations

import copy
import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT, Scratch, as_signed, delete_path, rolling, rows_of, shuffle_partitions, sliding_min, tidy, word_hashes

WIDTH = 35
GRAM = 8
BATCHES = 3
FAN_IN = 2
TIER = 2
#: Runs up to this many bytes are merged whatever their sizes.
FLOOR = 64 << 20
#: Texts whose copies a task recognizes (8 bytes each).
_RECENT = 500_000
#: Windows of a batch of rows that a worker holds.
_WINDOWS = 500_000


class FingerprintIndex:
    """Runs of fingerprints (fp, n, hi, lo) and windows (fp, full, n), where n is 1 or 2 (more), texts and rows by batch."""

    KEYS = {"fp": ["fp"], "window": ["fp", "full"], "text": ["hi", "lo"]}
    SCHEMAS = {"fp": "fp bigint, n tinyint, hi bigint, lo bigint", "window": "fp bigint, full bigint, n tinyint", "text": "hi bigint, lo bigint, copies bigint, fps array<bigint>, text binary"}

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, fan_in: int = FAN_IN):
        self.spark, self.root, self.fan_in = spark, root.rstrip("/"), fan_in
        found = self._load()
        if found and buckets not in (None, found["buckets"]):
            raise ValueError(f"{self.root} has {found['buckets']} buckets, not {buckets}")
        self.state = found or {"buckets": buckets or shuffle_partitions(spark), "version": 0, "batches": 0, "fp": [], "window": [], "text": []}
        if not found:
            self._commit([])  # what a first batch leaves, should it fail, isn't taken for a lost index

    # --- the folder

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self) -> list[str]:
        system, path = self._path()
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def _read(self, name: str) -> dict | None:
        """A manifest's state, or null if it is cut short."""
        try:
            state = json.loads("".join(r.value for r in self.spark.read.text(f"{self.root}/{name}").collect()))
        except json.JSONDecodeError:
            return None
        return state if "version" in state else None

    def _load(self) -> dict | None:
        names = self._names()
        manifests = sorted((n for n in names if n.startswith("manifest-") and n.endswith(".json")), reverse=True)
        state = next(filter(None, map(self._read, manifests)), None)
        if state is None:
            if any(not n.startswith(("manifest", ".")) for n in names):
                raise ValueError(f"{self.root} holds tables but no whole manifest")
            return None
        for kind in self.KEYS:
            for name in state[kind]:
                keys = ", ".join(self.KEYS[kind])
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({self.SCHEMAS[kind]}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {state['buckets']} BUCKETS LOCATION '{self.root}/{name}'")
        return state

    def _commit(self, old: list[str]) -> None:
        """Publishes the state as the next manifest, then deletes earlier ones and the tables that it no longer names."""
        before = [n for n in self._names() if n.startswith("manifest-")]
        self.state["version"] += 1
        name = f"manifest-{self.state['version']:012d}.json"
        system, fresh = self._path(f"{name}.new")
        out = system.create(fresh, True)
        out.write(bytearray(json.dumps(self.state).encode()))
        out.close()
        if not system.rename(fresh, self._path(name)[1]):
            raise OSError(f"{self.root}/{name} stands already: another writer?")
        for stale in before:
            delete_path(self.spark, f"{self.root}/{stale}")
        for table in old:
            self._drop(table)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(self.spark, f"{self.root}/{name}")

    def _write(self, frame: DataFrame, kind: str) -> str:
        name = f"{kind}_run_{uuid.uuid4().hex}"
        columns = [c.split()[0] for c in self.SCHEMAS[kind].split(", ")]
        with tidy(self.spark):
            frame.select(*columns).write.bucketBy(self.state["buckets"], *self.KEYS[kind]).sortBy(*self.KEYS[kind]).option("path", f"{self.root}/{name}").option("compression", "zstd").saveAsTable(name)
        return name

    def _save(self, frame: DataFrame, name: str) -> DataFrame:
        with tidy(self.spark):
            frame.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.root}/{name}")

    def _parts(self, name: str) -> DataFrame | None:
        """The tables of all batches by this name, as one."""
        return self.spark.read.parquet(*(f"{self.root}/{name}-{i}" for i in range(self.state["batches"]))) if self.state["batches"] else None

    # --- runs

    def merged(self, kind: str, runs: list[str] | None = None) -> DataFrame | None:
        """All runs of a kind, or some, merge-joined bucket by bucket."""
        out, keys = None, self.KEYS[kind]
        for name in self.state[kind] if runs is None else runs:
            run = self.spark.table(name)
            if out is None:
                out = run
                continue
            other = run.select(*keys, *(F.col(c).alias(f"__{c}") for c in run.columns if c not in keys))
            both = out.hint("merge").join(other, keys, "full_outer")
            n = F.least(F.coalesce("n", F.lit(0)) + F.coalesce("__n", F.lit(0)), F.lit(2)).cast("tinyint").alias("n")
            out = both.select(*keys, n, *(F.coalesce(c, f"__{c}").alias(c) for c in run.columns if c not in (*keys, "n")))
        return out

    def _bytes(self, name: str) -> int:
        system, path = self._path(name)
        return system.getContentSummary(path).getLength()

    def _compact(self, kind: str) -> list[str]:
        """Merges the newest runs that are near each other in size; the names of those that are in the new one."""
        runs = self.state[kind]
        if len(runs) <= self.fan_in:
            return []
        sizes = [self._bytes(name) for name in runs]
        first, total = len(runs) - 1, sizes[-1]
        while first and sizes[first - 1] <= max(TIER * total, FLOOR):
            first -= 1
            total += sizes[first]
        old = runs[first:]
        if len(old) < 2:
            return []
        self.state[kind] = [*runs[:first], self._write(self.merged(kind, old), kind)]
        return old

    # --- batches

    def add(self, batch: DataFrame) -> int:
        """Files a batch (doc_id, text as binary), finds and verifies what it repeats, and returns its number."""
        before = copy.deepcopy(self.state)
        try:
            return self._add(batch)
        except BaseException:
            self.state = before
            raise

    def _add(self, batch: DataFrame) -> int:
        self._sweep()
        number = self.state["batches"]
        described = self._save(_describe(batch), "described")
        self._save(described.select("doc_id", "hi", "lo", "n_words", "kept"), f"rows-{number}")
        firsts = [F.first(c, ignorenulls=True).alias(c) for c in ("fps", "text")]
        text = self._write(described.where(F.col("n_words") >= WIDTH).groupBy("hi", "lo").agg(F.count("*").alias("copies"), *firsts), "text")
        delete_path(self.spark, f"{self.root}/described")

        each = self.spark.table(text).select("hi", "lo", F.explode("fps").alias("fp"))
        fresh = self._write(each.groupBy("fp").agg(F.least(F.count("*"), F.lit(2)).cast("tinyint").alias("n"), F.max("hi").alias("hi"), F.max_by("lo", "hi").alias("lo")), "fp")
        history = self.merged("fp")
        run = self.spark.table(fresh)
        if history is None:
            met = run.select("fp", "n", F.lit(None).cast("tinyint").alias("m"), F.lit(None).cast("bigint").alias("hi"), F.lit(None).cast("bigint").alias("lo"))
        else:
            met = run.select("fp", "n").hint("merge").join(history.withColumnRenamed("n", "m"), "fp", "left")
        # Written plainly: a join with bucketed runs couldn't be split where a fingerprint is hot.
        due = self._save(met.where(F.col("n") + F.coalesce("m", F.lit(0)) > 1).select("fp", "m", "hi", "lo"), "due")
        pairs = each.join(due.select("fp"), "fp", "left_semi").select("hi", "lo", "fp")
        if history is not None:
            pairs = pairs.union(due.where("m = 1").select("hi", "lo", "fp"))  # old texts that are woken
        pairs = self._save(pairs.groupBy("hi", "lo").agg(F.collect_set("fp").alias("due")), "pairs")
        self.state["fp"].append(fresh)
        self.state["text"].append(text)
        windows = None
        for name in self.state["text"]:
            table = self.spark.table(name)
            if name != text:
                files = self._woken(table, pairs)
                if not files:
                    continue
                table = table.where(F.col("_metadata.file_path").isin(files))
            opened = _windows(table.select("hi", "lo", "copies", "text").join(pairs, ["hi", "lo"]))
            windows = opened if windows is None else windows.union(opened)
        windows = self._save(windows, f"windows-{number}")
        counted = _each(windows).groupBy("fp", "full").agg(F.least(F.count("*"), F.lit(2)).cast("tinyint").alias("n"))
        self.state["window"].append(self._write(counted, "window"))
        self.state["batches"] += 1
        old = [name for kind in ("fp", "window") for name in self._compact(kind)]
        self._commit(old)
        for name in ("due", "pairs"):
            delete_path(self.spark, f"{self.root}/{name}")
        return number

    def _woken(self, table: DataFrame, pairs: DataFrame) -> list[str]:
        """Files of an older batch's texts that hold one of the pairs' keys, by the keys alone; not more than it has files."""
        keyed = table.select("hi", "lo", F.col("_metadata.file_path").alias("file"))
        return [r.file for r in keyed.join(pairs.select("hi", "lo"), ["hi", "lo"], "left_semi").select("file").distinct().collect()]

    def _sweep(self) -> None:
        """Deletes runs that no manifest names: those of adds that failed."""
        named = {name for kind in self.KEYS for name in self.state[kind]}
        for name in self._names():
            if "_run_" in name and name not in named:
                self._drop(name)

    def known(self, batch: DataFrame) -> DataFrame:
        """Fingerprints of further documents (doc_id, text) that the index holds: what add() would look at."""
        found = _describe(batch).select(F.explode("fps").alias("fp")).distinct()
        held = self.merged("fp")
        return found.join(held.select("fp"), "fp", "left_semi") if held is not None else found.limit(0)

    def result(self, batches: list[int] | None = None, texts: bool = False) -> DataFrame:
        """doc_id, n_words, n_removed, kept_sha256 of the rows of all batches, or of some, judged on all; also kept_text if asked for."""
        twice = self._save(self.merged("window").where("n > 1").select("fp", "full"), "twice")
        single = self._parts("windows").where("copies = 1")
        hits = _each(single).join(twice, ["fp", "full"], "left_semi").groupBy("hi", "lo").agg(F.collect_list("at").alias("starts"))
        hits = self._save(hits, "hits")
        blank = [F.lit(None).cast(t).alias(c) for c, t in (("gone", "bigint"), ("kept_part", "string"), ("kept_text", "binary"))]
        verdicts, rows = None, self._parts("rows") if batches is None else self.spark.read.parquet(*(f"{self.root}/rows-{i}" for i in batches))
        for name in self.state["text"]:
            table = self.spark.table(name)
            some = _cut(table.where("copies = 1").select("hi", "lo", "text").join(hits, ["hi", "lo"]), texts)
            whole = table.where("copies > 1").select("hi", "lo", "copies", *blank)
            verdicts = some.union(whole) if verdicts is None else verdicts.union(some).union(whole)
        # A text that several batches hold has one verdict of each; all its windows are repeats, or it has none at all.
        verdicts = self._save(verdicts, "verdicts").dropDuplicates(["hi", "lo"])
        for name in ("twice", "hits"):
            delete_path(self.spark, f"{self.root}/{name}")
        copied = self.spark.read.parquet(f"{self.root}/verdicts").where("copies > 1")
        hot = F.broadcast(copied.where(F.col("copies") > rows.count() / HOT).select("hi", "lo").distinct().withColumn("hot", F.lit(True)))  # fewer than HOT rows
        short = rows.where(F.col("n_words") < WIDTH).select("hi", "lo", "doc_id", "n_words", "kept", F.lit(None).cast("boolean").alias("whole"), *blank)
        parted = rows.where(F.col("n_words") >= WIDTH).join(hot, ["hi", "lo"], "left").select("hi", "lo", "doc_id", "n_words", "kept", "hot")
        judged = parted.where("hot is null").drop("hot").join(verdicts.select("hi", "lo", (F.col("copies") > 1).alias("whole"), "gone", "kept_part", "kept_text"), ["hi", "lo"], "left")
        alike = parted.where("hot").drop("hot").select("*", F.lit(True).alias("whole"), *blank)
        out = judged.select(*alike.columns).union(alike).union(short)
        none = hashlib.sha256(b"").hexdigest()
        removed = F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0)))
        columns = ["doc_id", "n_words", removed.cast("long").alias("n_removed"), F.when(F.col("whole"), F.lit(none)).otherwise(F.coalesce("kept_part", "kept")).alias("kept_sha256")]
        if texts:
            columns.append(F.when(F.col("whole"), F.lit(b"")).otherwise(F.col("kept_text")).alias("kept_text"))
        return out.select(*columns)

    def close(self) -> None:
        """Forgets the tables' names; the folder stays as it is."""
        for kind in self.KEYS:
            for name in self.state[kind]:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def fingerprints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint of each window, hashes of the GRAM-word runs)."""
    grams = rolling(hashes, GRAM)
    return sliding_min(grams, WIDTH - GRAM + 1), grams


def _lists(arrays: list[np.ndarray], kind: pa.DataType, dtype: type) -> pa.ListArray:
    sizes = np.array([0, *map(len, arrays)]).cumsum()
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate([*arrays, np.empty(0, dtype)]), kind))


def _describe(source: DataFrame) -> DataFrame:
    """doc_id, hi, lo (key of the word sequence), n_words, kept (digest of all words), and fps and text of each row.

    A fingerprint stands twice if its words occur twice in the document. The first copy in a task carries the
    fingerprints and the text of all copies in it, for the others both are null, as for texts without a window.
    """
    id_type = dict(source.dtypes)["doc_id"]
    names = ["doc_id", "hi", "lo", "n_words", "kept", "fps", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                keys, counts, kept, fps, texts = [], [], [], [], []
                for (text,) in rows_of([part], "text"):
                    words = (text or b"").split()
                    hashes = word_hashes(words)
                    key = xxhash.xxh3_128_digest(hashes.tobytes())
                    keys.append(key)
                    counts.append(len(words))
                    kept.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    if len(words) < WIDTH or key in sent:
                        fps.append(None)
                        texts.append(None)
                        continue
                    if len(sent) >= _RECENT:
                        sent.clear()
                    sent.add(key)
                    least, grams = fingerprints(hashes)
                    least = np.unique(least)
                    grams.sort()
                    times = np.searchsorted(grams, least, "right") - np.searchsorted(grams, least, "left")
                    fps.append(as_signed(np.concatenate([least, least[times > 1]])))
                    texts.append(text)
                both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                arrays = [part.column(0), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(counts, pa.int64()), pa.array(kept, pa.string()), pa.array(fps, pa.list_(pa.int64())), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return source.mapInArrow(run, f"doc_id {id_type}, hi bigint, lo bigint, n_words bigint, kept string, fps array<bigint>, text binary")


def _windows(texts: DataFrame) -> DataFrame:
    """hi, lo, copies, and start, fingerprint and hash of each window under one of the row's fingerprints (due)."""
    names = ["hi", "lo", "copies", "at", "fp", "full"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, fp, full, keys, held = [], [], [], [], 0

        def pack() -> pa.RecordBatch:
            nonlocal held
            arrays = [*(pa.array([k[i] for k in keys], pa.int64()) for i in range(3)), _lists(at, pa.int32(), np.int32), _lists(fp, pa.int64(), np.int64), _lists(full, pa.int64(), np.int64)]
            for column in (at, fp, full, keys):
                column.clear()
            held = 0
            return pa.RecordBatch.from_arrays(arrays, names)

        for hi, lo, copies, text, due in rows_of(batches, "hi", "lo", "copies", "text", "due"):
            hashes = word_hashes(text.split())
            least, _ = fingerprints(hashes)
            found = np.flatnonzero(np.isin(least, np.array(due, np.int64).view(np.uint64)))
            at.append(found.astype(np.int32))
            fp.append(as_signed(least[found]))
            full.append(as_signed(rolling(hashes, WIDTH)[found]))
            keys.append((hi, lo, copies))
            held += len(found)
            if held >= _WINDOWS or len(keys) >= 2000:
                yield pack()
        if keys:
            yield pack()

    return texts.select("hi", "lo", "copies", "text", "due").mapInArrow(run, "hi bigint, lo bigint, copies bigint, at array<int>, fp array<bigint>, full array<bigint>")


def _each(windows: DataFrame) -> DataFrame:
    return windows.select("hi", "lo", F.explode(F.arrays_zip("at", "fp", "full")).alias("x")).select("hi", "lo", "x.*")


def cut(text: bytes, starts: list[int]) -> tuple[list[bytes], int]:
    """Words left and number removed, when the windows that begin at `starts` go."""
    words = text.split()
    covers = np.zeros(len(words) + 1, np.int64)
    starts = np.asarray(starts, np.int64)
    np.add.at(covers, starts, 1)
    np.add.at(covers, np.minimum(starts + WIDTH, len(words)), -1)
    gone = np.cumsum(covers[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], int(gone.sum())


def _cut(rows: DataFrame, texts: bool) -> DataFrame:
    names = ["hi", "lo", "copies", "gone", "kept_part", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                gone, kept, left = [], [], []
                for text, starts in rows_of([part], "text", "starts"):
                    words, n = cut(text, starts)
                    gone.append(n)
                    joined = b" ".join(words)
                    left.append(joined if texts else None)
                    kept.append(hashlib.sha256(joined).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([1] * len(gone), pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(left, pa.binary())], names)

    return rows.select("hi", "lo", "text", "starts").mapInArrow(run, "hi bigint, lo bigint, copies bigint, gone bigint, kept_part string, kept_text binary")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of docs; with texts=True also kept_text (binary; null: unchanged)."""
    scratch = Scratch(docs.sparkSession, "repeats")
    index = FingerprintIndex(docs.sparkSession, scratch.path("index"))
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    for i in range(batches):
        # By hash of the text: byte-equal copies come together; copies that differ in white space are found in any case.
        index.add(source.where(F.pmod(F.xxhash64(F.coalesce("text", F.lit(b"")), F.lit("batch")), F.lit(batches)) == i))
    out = index.result(texts=texts)
    index.close()
    return out
