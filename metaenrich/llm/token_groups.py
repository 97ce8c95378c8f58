"""Exact n-gram Jaccard join over a token-group matrix.

A document's set holds its distinct five-word shingles (A-Z lower-cased; fewer words: the whole sequence as one
shingle). Two documents link when 100 * |intersection| >= 80 * |union|; components() returns the connected
classes of these links.

Method:
1. Equal sets (by 128 bits) collapse to one node. Nodes are partitioned into groups of similar sets (same min-hash,
   dealt into chunks of at most about GROUP_SIZE).
2. The matrix holds, per group, the union of its members' tokens. Only prefix tokens are stored: in a global
   token order, sets that link share one of their first n - ceil(0.8 n) + 1 tokens. Tokens that occur often
   (by a count sketch) come last in that order, so common passages hardly ever nominate anything.
3. Groups are opened by themselves first, level by level (groups, then groups of their leaders), which joins
   large families without looking at all their pairs.
4. Queries then meet the groups with whose union they share a prefix token and in which someone is in another class
   still: first one group per token, then all that remain. From the sizes and the tokens that the query shares with the
   stored union follows a bound on the overlap with any member; only groups within it are opened, and only then do whole
   sets move. In an opened group the union of the whole sets bounds once more, then members are compared exactly. Pairs
   inside one class need no look, as they cannot change the classes. No pair that could link two classes is left out,
   whatever the sketch and the min-hash say: these only order and pack the work.

Texts are cut into words and shingles a block at a time, twice each: for the sketch and for the prefixes. One text of each
node moves, by its own hash, into a bucketed table that holds those of nodes which share a prefix token with another; sets
are made from it where they are needed. Nothing is joined by doc_id. A token, node or class may be hot: tokens
are counted before they move and then joined (adaptive execution may split them), rows meet the results of hot nodes and
classes by a bounded broadcast.

Null and empty texts have an empty set and link with nothing: n_shingles 0, component_id their own doc_id.
Repeated rows are copies of each other. A row without doc_id belongs to its class but never names it. Columns other than
key and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, Scratch, as_signed, join_hot, mix64, rolling, rows_of, shuffle_partitions, tidy

WIDTH = 5
#: Similarity in hundredths.
LEAST = 80
GROUP_SIZE = 48
#: Queries that meet one group in one task.
QUERY_BLOCK = 256
#: A token under which more than DENSE queries and groups would meet (LEAST_SIDE of either at least) is met in blocks of DENSE_BLOCK.
DENSE, LEAST_SIDE, DENSE_BLOCK = 4096, 32, 256
#: Tokens compared at a time in a block.
_COLUMNS = 4096
#: Slots of the count sketch (its classes are one byte each: 4 MB on every executor, at any input size).
SKETCH_BITS = 22
#: A slot is sent on from a task once it is hit so often there, and is common from so many hits in all.
SKETCH_LOCAL, SKETCH_COMMON = 5, 128
#: Sets whose copies a task recognizes.
_RECENT = 500_000
_GROUP_SALT = np.uint64(0xA0761D6478BD642F)
#: Bytes of text that are cut into words at a time, one text at least; rows of one Arrow batch that a task sends on.
_BLOCK_BYTES, _BLOCK_ROWS = 1 << 20, 256
#: A-Z lower-cased, white space as blanks.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz     ")
#: The first 0 to 8 bytes of a word read as one number; words over _LONG bytes are hashed one by one.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG = 64


def _words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, one after the other, and the number of words of each text."""
    whole = b"".join((b" ", b" ".join(t or b"" for t in texts), b" " * 8)).translate(_PLAIN)
    blank = np.frombuffer(whole, np.uint8) == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(whole) - 7, np.dtype("<u8"), whole, 0, (1,))  # the eight bytes from each place on
    hashes = mix64(sizes.astype(np.uint64) * BASE ^ (eight[starts] & _FIRST_BYTES[np.minimum(sizes, 8)]))
    done, more = 8, np.flatnonzero(sizes > 8)
    while len(more) and done < _LONG:
        hashes[more] = mix64(hashes[more] ^ (eight[starts[more] + done] & _FIRST_BYTES[np.minimum(sizes[more] - done, 8)]))
        done += 8
        more = more[sizes[more] > done]
    for i in more.tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(whole[starts[i] : starts[i] + sizes[i]])
    begins = np.cumsum([1] + [len(t or b"") + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, begins))


def shingle_block(texts: list[bytes | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text, one text after the other, and where each one's begin and end."""
    hashes, words = _words(texts)
    counts = np.where(words < width, np.minimum(words, 1), words - width + 1)
    ends, firsts = np.concatenate(([0], np.cumsum(counts))), np.cumsum(words) - words
    rolled = rolling(hashes, width)
    if len(rolled):
        # A text with fewer words has one place, filled below.
        tokens = rolled[np.minimum(np.repeat(firsts - ends[:-1], counts) + np.arange(ends[-1]), len(rolled) - 1)]
    else:
        tokens = np.zeros(ends[-1], np.uint64)
    for i in np.flatnonzero((words > 0) & (words < width)).tolist():
        tokens[ends[i]] = rolling(hashes[firsts[i] : firsts[i] + words[i]], words[i])[0] ^ np.uint64(words[i])
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        tokens[a:b].sort()
    distinct = np.ones(len(tokens), bool)
    distinct[1:] = tokens[1:] != tokens[:-1]
    distinct[ends[:-1][counts > 0]] = True
    return tokens[distinct], np.concatenate(([0], np.cumsum(distinct)))[ends]


def blocks(texts: Iterable[bytes | None]) -> Iterator[list[bytes | None]]:
    """The texts in lists of about _BLOCK_BYTES, or of one larger text, and of _BLOCK_ROWS at most."""
    block: list[bytes | None] = []
    size = 0
    for text in texts:
        if block and (size + len(text or b"") > _BLOCK_BYTES or len(block) == _BLOCK_ROWS):
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text or b"")
    if block:
        yield block


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    return shingle_block([text], width)[0]


def count_slots(slots: np.ndarray, tokens: np.ndarray) -> None:
    """Adds the hits of the tokens to the slots of a sketch."""
    found = np.sort((tokens & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int32))
    at = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else np.empty(0, np.int64)
    slots[found[at]] += np.diff(at, append=len(found)).astype(slots.dtype)


def prefix_length(n: int, least: int = LEAST) -> int:
    return n - -(-least * n // 100) + 1


def links(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> bool:
    """Whether two sorted sets are similar enough; sizes are looked at first."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < least * len(b) or not len(a):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int(np.count_nonzero(b[at] == a))
    return 100 * common >= least * (len(a) + len(b) - common)


class Classes:
    """Union-find over a task's nodes; the smallest node is the root."""

    def __init__(self, nodes: list[int]):
        self.up = {n: n for n in nodes}

    def find(self, n: int) -> int:
        while self.up[n] != n:
            self.up[n] = n = self.up[self.up[n]]
        return n

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _binary(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))


def common_tokens(docs: DataFrame) -> bytes:
    """Class of each sketch slot (0: not common, then one more per doubling), deflated. Bounded by the sketch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SKETCH_BITS, np.int32)
        for block in blocks(text for (text,) in rows_of(batches, "text")):
            count_slots(slots, shingle_block(block)[0])
        at = np.flatnonzero(slots >= SKETCH_LOCAL)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(slots[at].astype(np.int64))], ["slot", "hits"])

    hits = docs.select("text").mapInArrow(count, "slot int, hits bigint").groupBy("slot").agg(F.sum("hits").alias("hits")).where(F.col("hits") >= SKETCH_COMMON)
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    # At most one pair of numbers a slot; the sketch's size doesn't depend on the input.
    packed = hits.select("slot", (F.floor(F.log2(F.col("hits") / SKETCH_COMMON)) + 1).cast("int").alias("c")).toArrow()
    classes[packed.column("slot").to_numpy()] = packed.column("c").to_numpy()
    return zlib.compress(classes.tobytes(), 1)


class _Recent:
    """Recognizes what came before in its task, among the last _RECENT at least."""

    def __init__(self) -> None:
        self.seen: set = set()

    def new(self, key) -> bool:
        if key in self.seen:
            return False
        if len(self.seen) >= _RECENT:
            self.seen.clear()
        self.seen.add(key)
        return True


def _describe(docs: DataFrame, classes: bytes) -> DataFrame:
    """doc_id, n, hi, lo (content key of the set), and of the first copy in a task grp (min-hash), pre (prefix tokens) and digest (of its text)."""
    shipped = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, recent = np.frombuffer(zlib.decompress(shipped.value), np.uint8), _Recent()
        for batch in batches:
            start = 0
            for block in blocks(text for (text,) in rows_of([batch], "text")):
                tokens, ends = shingle_block(block)
                filled = np.flatnonzero(ends[1:] > ends[:-1])
                groups = np.zeros(len(block), np.int64)
                if len(filled):
                    groups[filled] = as_signed(np.minimum.reduceat(mix64(tokens ^ _GROUP_SALT), ends[:-1][filled]))
                cost, bounds = order[(tokens & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)], ends.tolist()
                rows: list[tuple] = []
                for i, text in enumerate(block):
                    own, dear = tokens[bounds[i] : bounds[i + 1]], cost[bounds[i] : bounds[i + 1]]
                    node = _node(own) if len(own) else None
                    if node is None or not recent.new(node):
                        rows.append((*(node or (None, None)), None, None, None))
                        continue
                    ranked = own[np.argsort(dear, kind="stable")] if dear.any() else own
                    rows.append((*node, groups[i], as_signed(ranked[: prefix_length(len(own))]), xxhash.xxh3_128_digest(text)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                made = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(block)), pa.array(np.diff(ends)), *made], ["doc_id", "n", "hi", "lo", "grp", "pre", "digest"])
                start += len(block)

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n bigint, hi bigint, lo bigint, grp bigint, pre array<bigint>, digest binary")


def _carried(docs: DataFrame) -> DataFrame:
    """digest and text of each text; copies in one task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = _Recent()
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK_ROWS):
                part = batch.slice(start, _BLOCK_ROWS).column(0)
                digests = [xxhash.xxh3_128_digest(text) if text else None for text in part.to_pylist()]
                first = pa.array([d is not None and recent.new(d) for d in digests], pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()).filter(first), part.filter(first)], ["digest", "text"])

    return docs.select("text").mapInArrow(run, "digest binary, text binary")


def _node(tokens: np.ndarray) -> tuple[int, int]:
    """Content key of a set: equal sets, and only they, are one node."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64).tolist())


class _Texts:
    """Texts of nodes (node, digest), bucketed, so that they don't move when some of them are asked for."""

    def __init__(self, scratch: Scratch, carried: DataFrame, nodes: DataFrame):
        self.spark, self.nodes, self.name = scratch.spark, nodes, f"texts_{uuid.uuid4().hex}"
        texts = carried.join(nodes, "digest").groupBy("digest").agg(F.first("node").alias("node"), F.first("text").alias("text"))
        with tidy(self.spark):
            texts.write.bucketBy(shuffle_partitions(self.spark), "digest").sortBy("digest").option("path", scratch.path("texts")).option("compression", "zstd").saveAsTable(self.name)

    def sets(self, needed: DataFrame) -> DataFrame:
        """node and the whole set of the nodes needed."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                start = 0
                for block in blocks(text for (text,) in rows_of([batch], "text")):
                    tokens, ends = shingle_block(block)
                    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(as_signed(tokens)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(block)), lists], ["node", "tokens"])
                    start += len(block)

        keys = self.nodes.join(needed.select("node"), "node", "left_semi").select("digest")
        return self.spark.table(self.name).join(keys, "digest", "left_semi").select("node", "text").mapInArrow(run, "node bigint, tokens array<bigint>")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _arrays(table: pa.Table) -> list[np.ndarray]:
    out = []
    for chunk in table.column("tokens").chunks:
        values, offsets = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [values[a:b].view(np.uint64) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return out


def _open_group(table: pa.Table) -> pa.Table:
    """Links inside one group: (node, root) of each member."""
    nodes, sets = table.column("node").to_pylist(), _arrays(table)
    classes = Classes(nodes)
    order = sorted(range(len(nodes)), key=lambda i: len(sets[i]))
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if 100 * len(sets[a]) < LEAST * len(sets[b]):
                break
            if classes.find(nodes[a]) != classes.find(nodes[b]) and links(sets[a], sets[b]):
                classes.join(nodes[a], nodes[b])
    return pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array([classes.find(n) for n in nodes], pa.int64())})


def _query_group(table: pa.Table) -> pa.Table:
    """Links of a block of queries (asks) with members of one group that are in other classes."""
    asks = table.column("asks")
    members, queries = table.filter(pc.invert(asks)), table.filter(asks)
    comps, sets = members.column("comp").to_pylist(), _arrays(members)
    found: list[tuple[int, int]] = []
    if comps and queries.num_rows:
        union = np.unique(np.concatenate(sets))
        seen = Classes(list({*comps, *queries.column("comp").to_pylist()}))
        for comp, tokens in zip(queries.column("comp").to_pylist(), _arrays(queries), strict=True):
            at = np.searchsorted(union, tokens)
            at[at == len(union)] = 0
            if 100 * int(np.count_nonzero(union[at] == tokens)) < LEAST * len(tokens):
                continue  # the bound: nobody in this group can be similar enough
            for other, members_set in zip(comps, sets, strict=True):
                if seen.find(comp) != seen.find(other) and links(tokens, members_set):
                    seen.join(comp, other)
                    found.append((comp, other))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp): the smallest node reachable over the edges (a, b), for each node that has one.

    Alternates two steps: hand the smallest neighbour to all larger ones, then to all smaller ones. Each round is
    written to the shared folder, which also cuts the lineage.
    """
    now = scratch.save(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-0")
    state = _state(now)
    for step in range(1, 200):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")).select(F.col("e.m").alias("a"), F.col("e.a").alias("b")).where("a <> b").distinct()
        now = scratch.save(small, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("comp"))
    raise RuntimeError("components did not settle")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _packed(scratch: Scratch, rows: DataFrame, step: int = 0) -> DataFrame:
    """Deals the nodes of each min-hash (grp) into chunks of about GROUP_SIZE: adds gid, k (nodes in it) and chunks.

    Only families of several chunks are written down and joined; as a table of its own their side can be broadcast where
    it is small, and a hot family's rows can be split.
    """
    families = rows.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(GROUP_SIZE)).alias("c")).where("c > 1")
    families = scratch.save(families, f"families-{step}")
    chunk = F.pmod(F.xxhash64("node", F.lit("chunk"), F.lit(step)), F.col("chunks"))
    dealt = rows.join(families, "grp", "left").withColumn("chunks", F.coalesce("c", F.lit(1).cast("bigint"))).drop("c").withColumn("gid", F.xxhash64("grp", chunk, F.lit(step)))
    return dealt.join(dealt.groupBy("gid").agg(F.count("*").alias("k")), "gid")


def _open_level(scratch: Scratch, dealt: DataFrame, sets: DataFrame, step: int) -> DataFrame:
    """(node, root) of the groups of a level that have several members."""
    groups = dealt.where("k > 1").select("node", "gid").join(sets, "node")
    return scratch.save(groups.groupBy("gid").applyInArrow(_open_group, "node bigint, root bigint"), f"opened-{step}")


def _leaders(dealt: DataFrame, opened: DataFrame) -> DataFrame:
    """(node, grp): of each chunk of a family the member with the most followers."""
    votes = dealt.where("chunks > 1").select("node", "gid", "grp").join(opened, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return votes.groupBy("gid", "grp", "root").agg(F.count("*").alias("k")).groupBy("gid", "grp").agg(F.max_by("root", F.struct("k", "root")).alias("node")).select("node", "grp")


def _merge(info: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """info with the classes (comp) that links between them join."""
    merged = connected(links, scratch, name).select(F.col("node").alias("comp"), F.col("comp").alias("final"))
    joined = join_hot(info, merged, ["comp"], info.groupBy("comp").agg(F.count("*").alias("k")), info.count())
    return scratch.save(joined.select("node", "n", "gid", F.coalesce("final", "comp").alias("comp")), f"info-{name}")


def _open_tokens(scratch: Scratch, matrix: DataFrame, info: DataFrame, name: str) -> DataFrame:
    """Rows of the matrix whose token stands in several classes, with size, class and group (to)."""
    rows = scratch.save(matrix.join(info.select("node", "n", "comp", F.xxhash64("gid", "comp").alias("to")), "node"), f"rows-{name}")
    differ = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    out = scratch.save(rows.join(differ, "token", "left_semi"), name)
    scratch.drop(f"rows-{name}")
    return out


def _wanted(n, n_lo, n_hi, ceil, most):
    """Prefix tokens that a query of size n must share with a group whose members have n_lo to n_hi tokens.

    The overlap is at most the shared prefix tokens and what stands behind one of the two prefixes.
    """
    return ceil((n + n_lo) * LEAST, 100 + LEAST) - most(ceil(n * LEAST, 100), ceil(n_hi * LEAST, 100)) + 1


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common tokens of each of the left sets with each of the right ones."""
    out = np.zeros((len(left), len(right)), np.float32)
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for start in range(0, len(both), _COLUMNS):
        some = both[start : start + _COLUMNS]
        sides = []
        for sets in (left, right):
            table = np.zeros((len(sets), len(some)), np.float32)
            for i, tokens in enumerate(sets):
                at = np.searchsorted(some, tokens)
                at[at == len(some)] = 0
                table[i, at[some[at] == tokens]] = 1
            sides.append(table)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _dense_block(table: pa.Table, ordered: bool) -> pa.Table:
    """(node, comp, to) of the pairs of a block of queries and one of groups that may link, at the first dense token they share."""
    asks = table.column("asks")
    queries, groups = table.filter(asks), table.filter(pc.invert(asks))
    rows: list[np.ndarray] = []
    if queries.num_rows and groups.num_rows:
        column = lambda side, name: side.column(name).to_numpy()
        sets = lambda side, name: [np.asarray(x, np.int64) for x in side.column(name).to_pylist()]
        comp, g_comp, n = column(queries, "comp")[:, None], column(groups, "comp")[None, :], column(queries, "n_lo")[:, None]
        n_lo, n_hi = column(groups, "n_lo")[None, :], column(groups, "n_hi")[None, :]
        fits = (comp > g_comp if ordered else comp != g_comp) & (n_lo * LEAST <= n * 100) & (n_hi * 100 >= n * LEAST)
        fits &= _shared(sets(queries, "tokens"), sets(groups, "tokens")) >= _wanted(n, n_lo, n_hi, lambda x, by: -(-x // by), np.maximum)
        if fits.any():
            fits &= _shared(sets(queries, "earlier"), sets(groups, "earlier")) == 0
        a, b = np.nonzero(fits)
        rows = [column(queries, "id")[a], column(queries, "comp")[a], column(groups, "id")[b]]
    rows = rows or [np.empty(0, np.int64)] * 3
    return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("node", "comp", "to"), rows, strict=True)})


def _dense_pairs(queries: DataFrame, groups: DataFrame, dense: DataFrame, ordered: bool) -> DataFrame:
    """(node, comp, to) that may link and share a dense token. Blocks of queries meet blocks of groups, each with all its prefix tokens."""

    def dealt(rows: DataFrame, key: str, own: str, others: str, asks: bool) -> DataFrame:
        inside = rows.join(dense, "token")
        listed = rows.groupBy(key).agg(F.collect_set("token").alias("tokens")).join(inside.groupBy(key).agg(F.collect_set("token").alias("all")), key)
        block, all_others = F.pmod(F.xxhash64(key, F.lit("dense")), F.col(own)).alias(own), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1)).alias(others)
        spread = inside.select("token", F.col(key).alias("id"), "comp", "n_lo", "n_hi", block, others).select("token", "id", "comp", "n_lo", "n_hi", own, all_others)
        met = spread.join(listed.withColumnRenamed(key, "id"), "id")
        return met.select("token", "qb", "gb", "id", "comp", "n_lo", "n_hi", "tokens", F.expr("filter(all, x -> x < token)").alias("earlier"), F.lit(asks).alias("asks"))

    asked = dealt(queries.select("token", "node", "comp", F.col("n").alias("n_lo"), F.col("n").alias("n_hi")), "node", "qb", "gb", True)
    held = dealt(groups.select("token", "to", F.col("g_comp").alias("comp"), "n_lo", "n_hi"), "to", "gb", "qb", False)
    return asked.union(held).groupBy("token", "qb", "gb").applyInArrow(lambda table: _dense_block(table, ordered), "node bigint, comp bigint, to bigint")


def _meet(scratch: Scratch, texts: _Texts, sets: DataFrame, info: DataFrame, queries: DataFrame, groups: DataFrame, ordered: bool, name: str) -> tuple[DataFrame, DataFrame]:
    """Opens the groups (token, to, g_comp) that queries (token, node, comp, n) may link with; returns the sets, grown, and the links.

    ordered: of two classes the one with the larger number asks; else both do. Few queries or groups meet under a token by a join. Where
    many do, as in a family of almost similar sets, which share many tokens, they meet in blocks: a pair that shares a
    dense token is judged there by all its tokens, any other shares none and so is counted whole by the join.
    """
    sizes = info.groupBy(F.xxhash64("gid", "comp").alias("to")).agg(F.min("n").alias("n_lo"), F.max("n").alias("n_hi"))
    apart = F.col("comp") > F.col("g_comp") if ordered else F.col("comp") != F.col("g_comp")
    fits = apart & (F.col("n_lo") * LEAST <= F.col("n") * 100) & (F.col("n_hi") * 100 >= F.col("n") * LEAST)
    count = lambda frame, as_: frame.groupBy("token").agg(F.count("*").alias(as_))
    loads = count(queries, "q").join(count(groups, "g"), "token").where((F.least("q", "g") >= LEAST_SIDE) & (F.col("q") * F.col("g") > DENSE))
    blocks = lambda side: F.ceil(F.col(side) / F.lit(DENSE_BLOCK)).alias(f"{side}b")
    dense = scratch.save(loads.select("token", blocks("q"), blocks("g")), f"dense-{name}")
    sized, thin, many = groups.join(sizes, "to"), queries, not dense.isEmpty()
    if many:
        thin = queries.join(dense.select("token"), "token", "left_anti")
    met = thin.select("token", "node", "comp", "n").join(sized, "token").where(fits).groupBy("node", "comp", "n", "to", "n_lo", "n_hi").agg(F.count("*").alias("c"))
    wanted = _wanted(F.col("n"), F.col("n_lo"), F.col("n_hi"), lambda x, by: F.ceil(x / F.lit(by)), F.greatest)
    pairs = met.where(F.col("c") >= wanted).select("node", "comp", "to")
    if many:
        pairs = pairs.union(_dense_pairs(queries, sized, dense, ordered)).distinct()
    pairs = scratch.save(pairs, f"pairs-{name}")

    members = info.select("node", "comp", F.xxhash64("gid", "comp").alias("to"))
    needed = pairs.select("node").union(members.join(pairs.select("to").distinct(), "to", "left_semi").select("node")).distinct()
    missing = scratch.save(needed.join(sets.select("node"), "node", "left_anti"), f"missing-{name}")
    sets = sets.union(scratch.save(texts.sets(missing), f"sets-{name}"))
    load = pairs.groupBy("to").agg(F.ceil(F.count("*") / F.lit(QUERY_BLOCK)).alias("blocks"))
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    asked = pairs.join(load, "to").select("node", "comp", "to", block.alias("block"), F.lit(True).alias("asks"))
    held = members.join(load, "to").select("node", "comp", "to", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("asks"))
    links = asked.union(held).join(sets, "node").drop("node").groupBy("to", "block").applyInArrow(_query_group, "a bigint, b bigint")
    return sets, scratch.save(links, f"links-{name}")


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the class) for each row of docs."""
    scratch = Scratch(docs.sparkSession, "groups")
    source = _binary(docs, key, text)
    described = scratch.save(_describe(source, common_tokens(source)), "described")
    rows = described.select("doc_id", "n", "hi", "lo")
    firsts = [F.first(c, ignorenulls=True).alias(c) for c in ("grp", "pre", "digest")]
    nodes = described.where("n > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("low"), F.count("*").alias("k"), F.first("n").alias("n"), *firsts)
    nodes = scratch.save(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    # Prefix tokens that more than one node has.
    each = nodes.select("node", F.explode("pre").alias("token"))
    shared = each.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    matrix = scratch.save(each.join(shared, "token", "left_semi"), "matrix")
    open_nodes = scratch.save(nodes.select("node", "digest", "grp", "n").join(matrix.select("node").distinct(), "node", "left_semi"), "open-nodes")
    texts = _Texts(scratch, _carried(source), open_nodes.select("digest", "node"))
    dealt = scratch.save(_packed(scratch, open_nodes.select("node", "grp", "n")), "dealt")

    # Groups open by themselves; then the leaders of a family's chunks form groups, until one is left.
    near = scratch.save(texts.sets(dealt.where("k > 1")), "sets-near")
    opened = _open_level(scratch, dealt, near, 0)
    edges, level, step = opened, dealt, 0
    while level.where("chunks > 1").limit(1).count():
        step += 1
        level = scratch.save(_packed(scratch, _leaders(level, opened), step), f"level-{step}")
        opened = _open_level(scratch, level, near, step)
        edges = edges.union(opened)
    edges = edges.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    first = connected(edges, scratch, "near")
    info = scratch.save(dealt.select("node", "n", "gid").join(first, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "info-near")

    # What is left: queries and groups (of one class each from here on) that share prefix tokens but not the class.
    # First every query meets one group per token only, the one with most members there: linear in the tokens, and it
    # joins much of a large family. Then all that still differ meet.
    open_ = _open_tokens(scratch, matrix, info, "open-hub")
    if not open_.isEmpty():
        counts = open_.groupBy("token", "to", "comp").agg(F.count("*").alias("k"))
        hubs = counts.groupBy("token").agg(F.max_by(F.struct("to", F.col("comp").alias("g_comp")), F.struct("k", "to")).alias("hub")).select("token", "hub.*")
        sets, links = _meet(scratch, texts, near, info, open_, hubs, False, "hub")
        info = _merge(info, links, scratch, "hub")
        open_ = _open_tokens(scratch, open_.select("token", "node"), info, "open-all")
    if not open_.isEmpty():
        # The matrix of what is open: tokens of the groups' unions.
        groups = scratch.save(open_.select("token", "to", F.col("comp").alias("g_comp")).distinct(), "unions")
        _, links = _meet(scratch, texts, sets, info, open_, groups, True, "all")
        info = _merge(info, links, scratch, "all")
    texts.drop()

    named = nodes.select("hi", "lo", "node", "low", "k").join(info.select("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = scratch.save(named, "named")
    ids = named.groupBy("comp").agg(F.min("low").alias("component_id"), F.count("*").alias("k"))
    ids = scratch.save(ids, "ids")
    of_node = join_hot(named.select("comp", "hi", "lo", F.col("k").alias("copies")), ids.select("comp", "component_id"), ["comp"], ids, named.count())
    of_node = scratch.save(of_node.select("hi", "lo", "component_id", "copies"), "of-node")
    filled, none = rows.where("hi is not null"), rows.where("hi is null").withColumn("component_id", F.lit(None).cast(dict(rows.dtypes)["doc_id"]))
    out = join_hot(filled, of_node.drop("copies"), ["hi", "lo"], of_node.select("hi", "lo", F.col("copies").alias("k")), rows.count()).unionByName(none)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
