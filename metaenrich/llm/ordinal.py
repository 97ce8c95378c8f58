"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades: 0 low quality, 1 well written but toxic, 2 good. One weight vector over hashed text features is shared by
all grades; ordered thresholds t1 < t2 cut its score: P(grade >= g) = sigmoid(score - t_g). Expected grade and the
tail probability P(grade >= 2) serve selection.

Features of the whole text: presence of each word (lower case, punctuation stripped), shares of token shapes (letters
as a, A, digits as 9, punctuation as it is), shares of tokens and lines that repeat, and how often words begin alike: for
the first characters of the words (as many as each of STEMS says), presence of each level of LEVELS that their rate
(occurrences by words + DAMP) reaches, so that a stem with ever other endings counts as one. All are hashed, words into
SLOTS, stems behind them.

Training reads at most SAMPLE labelled rows, those with the smallest key hash, one of each key; that bound doesn't depend
on the input. A word's or stem's weight is at most 0: however long a text is, its ordinary words don't make up for an insult.
Words and stem levels that fewer than MIN_ROWS of these rows have, or that are independent of the grade, get no weight.

Null and empty texts have no words and get the score of the bias; rows without label are scored like others; of
several labels of a row the lowest grade counts; without any label every row is kept. Repeated rows each get their
row, an empty table gives an empty result, other columns are ignored (select_good() keeps them).
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of

SLOTS = 1 << 18
SHAPE_SLOTS = 1 << 12
STEMS = (4, 5)
STEM_SLOTS = 1 << 18
#: Rates of a stem, each a feature of its own.
LEVELS = (1 / 256, 1 / 181, 1 / 128, 1 / 91, 1 / 64)
DAMP = 50
SAMPLE = 6000
MIN_ROWS = 8
#: Words whose z-score with every grade is below this get no weight: most words say nothing about quality.
SCREEN = 5.0
RIDGE = 1e-4
STEPS = 300
KEEP_FROM = 0.5
GRADES = 3
_CACHE = 300_000
_EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BEGIN = re.compile(r"^\W+")
_LOW, _UP, _NUM, _REST = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[A-Z]+"), re.compile(rb"[0-9]+"), re.compile(rb"([^\w])\1{2,}")


class Tokens(dict):
    """Word to (word slot, shape slot, number of its stem of each length or -1); a bounded cache."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        shape = _REST.sub(rb"\1\1\1", _NUM.sub(b"9", _UP.sub(b"A", _LOW.sub(b"a", word))))
        bare = word.lower().strip(_EDGES)
        plain = _BEGIN.sub("", bare.decode("utf-8", "replace").lower())
        found = (
            xxhash.xxh3_64_intdigest(bare) % (SLOTS - SHAPE_SLOTS) + SHAPE_SLOTS if bare else 0,
            xxhash.xxh3_64_intdigest(shape) % (SHAPE_SLOTS - 64) + 64,
            *(xxhash.xxh3_64_intdigest(plain[:n].encode()) % STEM_SLOTS if len(plain) >= n else -1 for n in STEMS),
        )
        if len(self) >= _CACHE:
            self.clear()
        self[word] = found
        return found


def features(text: bytes | None, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of a text."""
    words = (text or b"").split()
    n = len(words)
    if not n:
        return np.array([1]), np.array([1.0], np.float32)
    found = np.array([tokens[w] for w in words])
    present = np.unique(found[:, 0])
    shapes, counts = np.unique(found[:, 1], return_counts=True)
    runs = float(np.count_nonzero(found[1:, 0] == found[:-1, 0])) / n
    lines = [x for x in text.split(b"\n") if x]
    again = 1 - len(set(lines)) / max(1, len(lines))
    rated = []
    for k in range(len(STEMS)):
        stems, times = np.unique(found[found[:, 2 + k] >= 0, 2 + k], return_counts=True)
        rates = times / (n + DAMP)
        rated += [stems[rates >= least] + (SLOTS + (k * len(LEVELS) + i) * STEM_SLOTS) for i, least in enumerate(LEVELS)]
    stems = np.concatenate(rated)
    dense = [(2, 1.0), (3, 5 * runs), (4, 2 * again), (5, 2 * (1 - len(present) / n) * n / (n + DAMP)), (6 + min(9, n.bit_length()), 1.0)]
    slots = np.concatenate([present[present > 0], stems, shapes, [d[0] for d in dense]])
    values = np.concatenate([np.ones(np.count_nonzero(present > 0) + len(stems)), 3 * np.sqrt(counts / n), [d[1] for d in dense]])
    return slots, values.astype(np.float32)


@dataclass
class OrdinalModel:
    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= g) for g = 1, 2."""
        return 1 / (1 + np.exp(-(score[:, None] - self.cuts[None, :])))


def _association(slot: np.ndarray, grade_of: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Largest z-score of each slot over the grades: rows with the slot against what independence would give."""
    total, held = len(grades), np.bincount(slot)
    best = np.zeros(len(held))
    for g in range(GRADES):
        share = np.mean(grades == g)
        spread = np.sqrt(np.maximum(held * share * (1 - share) * (1 - held / (total + 1)), 1e-9))
        best = np.maximum(best, np.abs(np.bincount(slot, grade_of == g, len(held)) - held * share) / spread)
    return best


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, steps: int = STEPS, ridge: float = RIDGE, min_rows: int = MIN_ROWS) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on the whole sample; grades weigh the inverse of their frequency's root."""
    sizes = np.array([len(s) for s, _ in rows])
    slots, values = np.concatenate([s for s, _ in rows]), np.concatenate([v for _, v in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), sizes)
    used, slot = np.unique(slots, return_inverse=True)
    often = (np.bincount(slot) >= min(min_rows, len(rows))) & ((used < SHAPE_SLOTS) | (_association(slot, grades[row], grades) >= SCREEN))
    keep = often[slot]
    slot, row, values = slot[keep], row[keep], values[keep]
    m, word = len(used), used >= SHAPE_SLOTS
    share = np.bincount(grades, minlength=GRADES) / len(grades)
    weight = 1 / np.sqrt(np.maximum(share[grades], 1e-3))
    weight /= weight.sum()
    w, cuts = np.zeros(m), np.array([-1.0, np.log(1.0)])  # first cut, log of the gap
    mean, var = np.zeros(m + 2), np.zeros(m + 2)
    for step in range(1, steps + 1):
        score = np.bincount(row, values * w[slot], len(rows))
        t = np.array([cuts[0], cuts[0] + np.exp(cuts[1])])
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - t, -40, 40)))
        upper = np.column_stack([np.ones(len(rows)), tail, np.zeros(len(rows))])
        each = np.arange(len(rows))
        high, low = upper[each, grades], upper[each, grades + 1]
        chance = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / chance * weight, low * (1 - low) / chance * weight
        d_score = -(d_high - d_low)
        d_cut = np.array([np.sum(d_high[grades == g]) - np.sum(d_low[grades == g - 1]) for g in (1, 2)])
        grad = np.concatenate([np.bincount(slot, values * d_score[row], m) + ridge * w, [d_cut.sum(), d_cut[1] * np.exp(cuts[1])]])
        mean, var = 0.9 * mean + 0.1 * grad, 0.99 * var + 0.01 * grad**2
        move = 0.08 * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-6)
        w -= move[:m]
        w[word] = np.minimum(w[word], 0)  # a word or stem can lower the grade, never make up for another one
        cuts -= move[m:]
    weights = np.zeros(SLOTS + len(STEMS) * len(LEVELS) * STEM_SLOTS, np.float32)
    weights[used[often]] = w[often]
    return OrdinalModel(weights, np.array([cuts[0], cuts[0] + np.exp(cuts[1])]))


def grade(quality: F.Column, toxic: F.Column) -> F.Column:
    return F.when(quality < 1, 0).when(toxic > 0, 1).otherwise(2)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> OrdinalModel | None:
    """Fits on at most `sample` labelled rows; None if no row has a label."""
    rated = labels.where("quality is not null").select(F.col(key).alias("k"), grade(F.col("quality"), F.coalesce(F.col("toxic"), F.lit(0))).alias("g")).where("k is not null").groupBy("k").agg(F.min("g").alias("g"))
    # The sample is chosen among the narrow label rows; at most `sample` keys then look for their text.
    chosen = F.broadcast(rated.orderBy(F.xxhash64("k", F.lit("ordinal")), "k").limit(sample))
    source = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("text")).join(chosen, "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            keys, grades, packed = [], [], []
            for k, g, body in rows_of([batch], "k", "g", "text"):
                slots, values = features(body, tokens)
                keys.append(xxhash.xxh3_64_intdigest(str(k)) >> 1)
                grades.append(g)
                packed.append(zlib.compress(pickle.dumps((slots.astype(np.int32), values.astype(np.float16))), 1))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(grades, pa.int32()), pa.array(packed, pa.binary())], ["k", "g", "row"])

    # However many rows share a labelled key, one of them counts.
    packed = source.select("k", "g", "text").mapInArrow(run, "k bigint, g int, row binary")
    rows = packed.groupBy("k", "g").agg(F.min("row").alias("row")).limit(sample).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.k, bytes(r.row)))
    return fit([pickle.loads(zlib.decompress(bytes(r.row))) for r in rows], np.array([r.g for r in rows]))


def score(docs: DataFrame, model: OrdinalModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, expected_grade, p_toxic_or_better, p_good, keep for each row; rows stay in their partition."""
    id_type = dict(docs.dtypes)[key]
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    score_of = _scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tails_of = score_of()
        for batch in batches:
            tails = tails_of([t for (t,) in rows_of([batch], "text")])
            columns = [tails.sum(axis=1), tails[:, 0], tails[:, 1]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.float64()) for c in columns), pa.array(tails[:, 1] >= KEEP_FROM)], ["doc_id", "expected_grade", "p_not_low", "p_good", "keep"])

    return source.mapInArrow(run, f"doc_id {id_type}, expected_grade double, p_not_low double, p_good double, keep boolean")


def _scorer(docs: DataFrame, model: OrdinalModel | None):
    """A function for the executors that makes one which gives the tail probabilities of texts."""
    shipped = docs.sparkSession.sparkContext.broadcast(zlib.compress(pickle.dumps(model), 1))

    def make():
        own, tokens = pickle.loads(zlib.decompress(shipped.value)), Tokens()

        def tails(texts: list[bytes | None]) -> np.ndarray:
            if own is None:
                return np.ones((len(texts), 2))
            scores = np.zeros(len(texts))
            for i, text in enumerate(texts):
                slots, values = features(text, tokens)
                scores[i] = own.weights[slots] @ values
            return own.tails(scores)

        return tails

    return make


def select_good(docs: DataFrame, model: OrdinalModel | None, text: str = "text") -> DataFrame:
    """Rows of docs (all their columns) whose tail probability reaches KEEP_FROM."""
    score_of = _scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tails_of = score_of()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                bodies = part.column(part.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
                yield part.filter(pa.array(tails_of(bodies)[:, 1] >= KEEP_FROM))

    return docs.mapInArrow(run, docs.schema)
