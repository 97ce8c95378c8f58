"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared in a plain form: lower case, runs of white space as one blank. An item of m characters
may be found with up to k = max(1, m // CHARS_PER_EDIT) edits (insertions, deletions, replacements of characters) as a
substring of a document. Below MIN_EDIT characters an edit would turn one word into another, so k = 0 there, and neither
a letter nor a digit may stand beside the hit.

Method: the item is split into k + 1 pieces. If it occurs with at most k edits, one piece at least occurs exactly
(pigeonhole). An Aho-Corasick automaton finds all piece hits in one pass over a document; around each hit, Myers'
bit-parallel algorithm gives the least distance of the whole item to any substring of the possible stretch, so every
occurrence within the budget is found and nothing beyond it is.

Items stand on the executors in blocks of at most BLOCK_CHARS characters (an item longer than that is a block of its
own); documents are read once per block and never move. Item ids may be of any type. Null or empty items match
nothing, null or empty texts hold nothing; repeated rows each give their own rows; a table without items or documents
gives an empty result. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import rows_of

CHARS_PER_EDIT = 24
MIN_EDIT = 12
BLOCK_CHARS = 4_000_000
BLOCK_ITEMS = 20_000


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def budget(m: int) -> int:
    return max(1, m // CHARS_PER_EDIT) if m >= MIN_EDIT else 0


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of budget + 1 pieces of nearly equal length that make up the item."""
    n = budget(len(item)) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Myers:
    """Least edit distance of a pattern to substrings of a text, a column of the matrix in one integer."""

    def __init__(self, pattern: str):
        self.m = len(pattern)
        self.ones = (1 << self.m) - 1
        self.top = 1 << (self.m - 1)
        self.at: dict[str, int] = defaultdict(int)
        for i, c in enumerate(pattern):
            self.at[c] |= 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end of the first stretch that has it)."""
        up, down, ones, top, at = self.ones, 0, self.ones, self.top, self.at
        score = best = self.m
        end = 0
        for j, c in enumerate(text, 1):
            eq = at.get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph = (down | ~(xh | up)) & ones
            mh = up & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = ph << 1 & ones
            mh = mh << 1 & ones
            up = (mh | ~(xv | ph)) & ones
            down = ph & xv
            if score < best:
                best, end = score, j
        return best, end


class Matcher:
    """A block of items: finds each item that occurs in a text within its budget."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = {}
        uses: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for key, text in items:
            item = plain(text or "")
            if not item:
                continue
            slot = len(self.items)
            self.items[slot] = (key, item)
            for offset, piece in pieces(item):
                uses[piece].append((slot, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in uses.items():
            self.automaton.add_word(piece, (len(piece), found))
        if uses:
            self.automaton.make_automaton()
        self.any = bool(uses)
        self.patterns: dict[int, Myers] = {}

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item key, least distance, approximate start in the plain text), one for each item found."""
        if not self.any:
            return []
        body = plain(text)
        hits: dict[int, set[int]] = defaultdict(set)
        out = []
        for last, (size, uses) in self.automaton.iter(body):
            for slot, offset in uses:
                hits[slot].add(last - size + 1 - offset)
        for slot, starts in hits.items():
            found = self._verify(slot, sorted(starts), body)
            if found is not None:
                out.append((self.items[slot][0], *found))
        return out

    def _verify(self, slot: int, starts: list[int], body: str) -> tuple[int, int] | None:
        item = self.items[slot][1]
        m, k = len(item), budget(len(item))
        for start in starts:
            if start >= 0 and body.startswith(item, start) and (k or not (body[max(0, start - 1) : start].isalnum() or body[start + m : start + m + 1].isalnum())):
                return 0, start
        if not k:
            return None
        if slot not in self.patterns:
            self.patterns[slot] = Myers(item)
        best = None
        i = 0
        while i < len(starts):  # overlapping stretches are read once
            low, high = starts[i] - k, starts[i] + m + k
            while i + 1 < len(starts) and starts[i + 1] - k <= high:
                i += 1
                high = starts[i] + m + k
            i += 1
            stretch = max(0, low)
            distance, end = self.patterns[slot].best(body[stretch:high])
            if distance <= k and (best is None or distance < best[0]):
                best = distance, max(0, stretch + end - m)
        return best


def blocks(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; only one block at a time is in memory."""
    block, chars = [], 0
    for row in items.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null").toLocalIterator():
        block.append((row.k, row.t))
        chars += len(row.t)
        if chars >= BLOCK_CHARS or len(block) >= BLOCK_ITEMS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def find_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, distance, at: one row for each document and item found in it."""
    spark = docs.sparkSession
    schema = f"doc_id {dict(docs.dtypes)[key]}, item_id {dict(items.dtypes)[item_key]}, distance bigint, at bigint"
    item_type = to_arrow_type(items.schema[item_key].dataType)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    out = None
    for block in blocks(items, item_key, item_text):
        shipped = spark.sparkContext.broadcast(pickle.dumps(block))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(pickle.loads(shipped.value))
            for batch in batches:
                rows = [(doc, *found) for doc, body in rows_of([batch], "doc_id", "text") for found in matcher.find(body)]
                kinds = [batch.schema.field("doc_id").type, item_type, pa.int64(), pa.int64()]
                columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "distance", "at"])

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows of docs (all their columns) in which no item is found. Rows stay in their partition."""
    for block in blocks(items, item_key, item_text):
        shipped = docs.sparkSession.sparkContext.broadcast(pickle.dumps(block))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(pickle.loads(shipped.value))
            for batch in batches:
                bodies = batch.column(batch.schema.get_field_index(text))
                clean = [not matcher.find(t or "") for start in range(0, batch.num_rows, 512) for t in bodies.slice(start, 512).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
