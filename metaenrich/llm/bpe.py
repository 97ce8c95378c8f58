"""BPE encoding and decoding with a public vocabulary file.

Method: the symbols of a word stand in a doubly linked list; a priority queue holds the merge rank of each
neighbouring pair; the lowest rank merges first, and entries whose pair has changed meanwhile are stale and
skipped. Decoding concatenates vocabulary strings (with the blanks that a vocabulary without decoder gets).

Null text counts as empty: no ids, an empty decoded text. Any other columns are ignored, repeated rows each
give their own row, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of

VOCABULARY = "word_bpe_49k.json"
#: Words and chunks kept by a worker, in two generations of which the older one goes. Bounds memory, never results.
CACHE_ENTRIES = 400_000
#: The vocabulary file travels in the task's closure; larger ones are refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Characters that str.split() takes for white space and Unicode's White_Space doesn't.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_alphabet() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 stands for itself, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(256)) - set(own)))}


class WordBpe:
    """One vocabulary: text to ids and back."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in special.items()}
        self.special = special
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        #: Rank of a pair, which is one number (no id is `wide` - 1, so that an unknown byte, -1, is in no pair); and what a rank makes.
        self.wide = max(self.vocab.values()) + 2
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self.vocab[left] * self.wide + self.vocab[right]] = rank
            self.made.append(self.vocab[left + right])
        alphabet = byte_alphabet()
        self.inner = [self.vocab.get(alphabet[b], -1) for b in range(256)]
        self.last = [self.vocab.get(alphabet[b] + self.end, -1) for b in range(256)]
        split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}"))
        self.words: dict[str, tuple[int, ...]] = {}
        self.old_words: dict[str, tuple[int, ...]] = {}

    def word(self, text: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        data = text.encode("utf-8", "surrogatepass")
        symbols = [self.inner[b] for b in data[:-1]]
        symbols.append(self.last[data[-1]])
        n = len(symbols)
        if n == 1:
            return (symbols[0],)
        rank_of, made, wide = self.ranks.get, self.made, self.wide
        # The rank of the pair that begins at a symbol: an entry of another rank is stale.
        ranks = [rank_of(a * wide + b, -1) for a, b in zip(symbols, symbols[1:])]
        heap = [r * n + i for i, r in enumerate(ranks) if r >= 0]
        if heap:
            ranks.append(-1)
            heapify(heap)
            after = list(range(1, n + 1))
            before = list(range(-1, n - 1))
            while heap:
                rank, i = divmod(heappop(heap), n)
                if ranks[i] != rank:
                    continue
                merged = symbols[i] = made[rank]
                j = after[i]
                symbols[j] = ranks[j] = ranks[i] = -1
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    r = ranks[i] = rank_of(merged * wide + symbols[k], -1)
                    if r >= 0:
                        heappush(heap, r * n + i)
                h = before[i]
                if h >= 0:
                    r = ranks[h] = rank_of(symbols[h] * wide + merged, -1)
                    if r >= 0:
                        heappush(heap, r * n + h)
        return tuple([s for s in symbols if s >= 0])

    def chunk(self, raw: str) -> list[int]:
        """Ids of a stretch without white space and special tokens."""
        text = raw
        if not raw.isascii():
            # Letters are lowered one by one, so a final sigma is an ordinary one.
            text = unicodedata.normalize("NFC", raw).replace("Σ", "σ")
        ids: list[int] = []
        words = self.words
        for piece in self.pieces.findall(text.lower()):
            found = words.get(piece)
            if found is None:
                if len(words) >= CACHE_ENTRIES // 2:
                    self.old_words, self.words = words, {}
                    words = self.words
                found = words[piece] = self.old_words.get(piece) or self.word(piece)
            ids.extend(found)
        return ids

    def chunks(self, text: str) -> list[str]:
        """Text in stretches between white space, special tokens standing alone."""
        if self.special_split is not None and "<|" in text:
            out = []
            for i, part in enumerate(self.special_split.split(text)):
                out += [part] if i % 2 else self._spaces(part)
            return out
        return self._spaces(text)

    @staticmethod
    def _spaces(text: str) -> list[str]:
        if any(c in text for c in _NOT_SPACE):
            return [c for c in regex.split(r"\p{White_Space}+", text) if c]
        return text.split()

    def encode(self, text: str) -> list[int]:
        return [i for c in self.chunks(text) for i in ([self.special[c]] if c in self.special else self.chunk(c))]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids if i in self.strings])


class _Chunks(dict):
    """Chunk to (little-endian ids, decoded string)."""

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.bpe = bpe
        self.old: dict[str, tuple[bytes, str]] = {}

    def __missing__(self, raw: str) -> tuple[bytes, str]:
        found = self.old.get(raw) or self._encode(raw)
        if len(raw) <= 64:
            if len(self) >= CACHE_ENTRIES // 2:
                self.old = dict(self)
                self.clear()
            self[raw] = found
        return found

    def _encode(self, raw: str) -> tuple[bytes, str]:
        ids = [self.bpe.special[raw]] if raw in self.bpe.special else self.bpe.chunk(raw)
        return struct.pack(f"<{len(ids)}I", *ids), self.bpe.decode(ids)


def read_vocabulary(path: str) -> str:
    """The vocabulary file, read on the driver."""
    with open(path, encoding="utf-8") as file:
        spec = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(spec) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary larger than {MAX_VOCABULARY_BYTES} bytes")
    return spec


def encode_documents(docs: DataFrame, spec: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = True, digests: bool = False) -> DataFrame:
    """`keep` columns, n_tokens, and the ids (array<int>) and/or SHA-256 digests of ids and decoded text.

    Rows stay in their partition: no shuffle. `spec` is the content of the vocabulary file (bounded).
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(spec)
    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    fields += ["n_tokens bigint"] + ["ids array<int>"] * ids + ["ids_sha256 string", "decoded_sha256 string"] * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Chunks(WordBpe(shipped.value))
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                counts, packed, id_hash, text_hash = [], [], [], []
                for value in batch.column(batch.num_columns - 1).to_pylist():
                    found = [cache[c] for c in cache.bpe.chunks(value or "")]
                    joined = b"".join([f[0] for f in found])
                    counts.append(len(joined) // 4)
                    if ids:
                        packed.append(joined)
                    if digests:
                        id_hash.append(hashlib.sha256(joined).hexdigest())
                        text_hash.append(hashlib.sha256(" ".join([f[1] for f in found]).encode("utf-8", "surrogatepass")).hexdigest())
                columns = [*batch.columns[:-1], pa.array(counts, pa.int64())]
                if ids:
                    offsets = pa.array([0, *_running(counts)], pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.Array.from_buffers(pa.int32(), sum(counts), [None, pa.py_buffer(b"".join(packed))])))
                if digests:
                    columns += [pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_tokens", *["ids"] * ids, *["ids_sha256", "decoded_sha256"] * digests])

    return source.mapInArrow(run, ", ".join(fields))


def _running(counts: list[int]) -> list[int]:
    total, out = 0, []
    for n in counts:
        total += n
        out.append(total)
    return out


def decode_documents(encoded: DataFrame, spec: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and the decoded text of an `ids` column; null ids decode to null."""
    shipped = encoded.sparkSession.sparkContext.broadcast(spec)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*keep).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(shipped.value)
        for batch in batches:
            texts = [None if ids is None else bpe.decode(ids) for (ids,) in rows_of([batch], "ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "decoded"])

    return encoded.select(*keep, "ids").mapInArrow(run, ", ".join([*fields, "decoded string"]))
