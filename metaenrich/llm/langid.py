"""Language identification with string kernels.

Kernel: the blended spectrum of the text's character n-grams (1 to MAX_GRAM, lower-cased, digits and punctuation as
blanks), by presence: k(x, y) = |grams(x) & grams(y)| / sqrt(|grams(x)| |grams(y)|). N-grams are hashed into DIMS
slots. LANDMARKS training texts give the Nyström features; one-versus-rest kernel ridge regression is solved in their
span on the driver. Batches of documents are scored by two matrix products: presence x landmarks, then x weights.

Training learns every language that the rows have. It uses at most SAMPLE / languages rows of each, or LEAST_ROWS if that
is more (the ones with the smallest key hash), each reduced to its presence bits before it reaches the driver; that bound
depends on the number of languages, not on the rows. There are LANDMARKS landmarks, or one a language if that is more.
Prediction reads whole texts.

Null texts and texts without a letter get `und` and score 0. If no row has a language, all get `und`. Repeated rows
each get their row, an empty table an empty result; a null doc_id counts as held out from training. Columns other
than those named are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import rows_of

DIMS = 1 << 13
MAX_GRAM = 4
SAMPLE = 3000
LEAST_ROWS = 8
LANDMARKS = 160
RIDGE = 1e-2
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
#: Code points of one scoring block; bounds the working memory, not the text.
_BLOCK_CHARS = 1 << 19
_SALTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


def _fold(text: str) -> np.ndarray:
    """Code points of the lower-cased text, everything but letters as blanks."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = ((points >= 97) & (points <= 122)) | ((points >= 0xAA) & (points != 0xD7) & (points != 0xF7) & ~((points >= 0x2000) & (points <= 0x2BFF)) & ~((points >= 0x3000) & (points <= 0x303F)))
    return np.where(plain, points, np.uint32(32))


def mark(text: str, row: np.ndarray) -> None:
    """Sets the slots of the text's n-grams in a row of zeros. Long texts are read in overlapping blocks."""
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    for start in range(0, max(1, len(text)), _BLOCK_CHARS):
        stop = start + _BLOCK_CHARS
        points = _fold(f"{'' if start else ' '}{text[max(0, start - MAX_GRAM + 1) : stop]}{'' if stop < len(text) else ' '}")
        grown = np.zeros(len(points), np.uint32)
        for n in range(1, MAX_GRAM + 1):
            if len(points) < n:
                break
            grown = grown[: len(points) - n + 1] * np.uint32(0x01000193) + (points[n - 1 :] + _SALTS[n]) * _SALTS[0]
            slots = (grown ^ (grown >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            row[slots >> shift] = 1


@dataclass
class KernelModel:
    languages: list[str]
    landmarks: np.ndarray  # DIMS x m, columns of unit length
    weights: np.ndarray  # m x languages

    def scores(self, presence: np.ndarray) -> np.ndarray:
        length = np.sqrt(presence.sum(axis=1, dtype=np.float32))
        kernel = (presence @ self.landmarks) / np.maximum(length, 1)[:, None]
        return kernel @ self.weights


def fit(bits: list[bytes], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel:
    """Kernel ridge regression in the span of the landmarks, which are dealt evenly over the languages, one at least for each."""
    languages = sorted(set(labels))
    number = {name: i for i, name in enumerate(languages)}
    own = np.array([number[x] for x in labels])
    by_language: list[list[int]] = [[] for _ in languages]
    for i, x in enumerate(own.tolist()):
        by_language[x].append(i)

    def unit(rows: list[int]) -> np.ndarray:
        presence = np.stack([np.unpackbits(np.frombuffer(bits[i], np.uint8)) for i in rows]).astype(np.float32)
        return presence / np.sqrt(np.maximum(presence.sum(axis=1), 1))[:, None]

    turn = [i for k in range(max(map(len, by_language))) for rows in by_language for i in rows[k : k + 1]]
    chosen = unit(turn[: min(max(landmarks, len(languages)), len(turn))])
    target = np.where(own[:, None] == np.arange(len(languages)), 1.0, -1.0)
    cross = np.concatenate([unit(list(range(i, min(i + 1024, len(bits))))) @ chosen.T for i in range(0, len(bits), 1024)]).astype(np.float64)
    inner = (chosen @ chosen.T).astype(np.float64)
    # Rows weigh the inverse of their language's share, so that frequent languages don't win short texts.
    share = 1 / np.bincount(own)[own]
    share *= len(labels) / share.sum()
    left = cross.T @ (cross * share[:, None]) + ridge * len(labels) / len(chosen) * inner + 1e-8 * np.eye(len(chosen))
    weights = np.linalg.solve(left, cross.T @ (target * share[:, None]))
    return KernelModel(languages, np.ascontiguousarray(chosen.T), weights.astype(np.float32))


def held_out(key: F.Column) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> KernelModel | None:
    """A model of the rows that aren't held out; at most `sample`, or LEAST_ROWS a language, of them are read."""
    labelled = docs.where(~held_out(F.col(key)) & F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}"))
    # One scan counts the languages, the next one draws by the key's hash slightly more rows than wanted; only these
    # few rows are ranked.
    sizes = {r.lang: r.n for r in labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    each = max(LEAST_ROWS, sample // len(sizes))
    shares = docs.sparkSession.createDataFrame([(name, min(1.0, 1.3 * (each + 20) / n)) for name, n in sizes.items()], "lang string, share double")
    rank = F.xxhash64(F.col(key), F.col(text), F.lit("langid"))
    drawn = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), rank.alias("h")).join(F.broadcast(shares), "lang").where(F.pmod("h", F.lit(1 << 40)) < F.col("share") * float(1 << 40))
    first = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h")
    taken = drawn.withColumn("i", F.row_number().over(first)).where(F.col("i") <= each).select("text", "lang", "h")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, langs, order = [], [], []
            for body, name, h in rows_of([batch], "text", "lang", "h"):
                row = np.zeros(DIMS, np.uint8)
                mark(body, row)
                bits.append(np.packbits(row).tobytes())
                langs.append(name)
                order.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.binary()), pa.array(langs, pa.string()), pa.array(order, pa.int64())], ["bits", "lang", "h"])

    rows = sorted(taken.mapInArrow(pack, "bits binary, lang string, h bigint").collect(), key=lambda r: (r.lang, r.h, bytes(r.bits)))
    return fit([bytes(r.bits) for r in rows], [r.lang for r in rows]) if rows else None


def predict(docs: DataFrame, model: KernelModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row; rows stay in their partition."""
    id_type = dict(docs.dtypes)[key]
    shipped = docs.sparkSession.sparkContext.broadcast(zlib.compress(pickle.dumps(model), 1))
    source = docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(zlib.decompress(shipped.value))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = part.column(2).to_pylist()
                names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                rows = [i for i, t in enumerate(texts) if own is not None and t and _LETTER.search(t)]
                if rows:
                    presence = np.zeros((len(rows), DIMS), np.float32)
                    for at, i in enumerate(rows):
                        mark(texts[i], presence[at])
                    found = own.scores(presence)
                    weight = np.exp(4 * (found - found.max(axis=1, keepdims=True)))
                    sure = weight.max(axis=1) / weight.sum(axis=1)
                    for at, i in enumerate(rows):
                        names[i], scores[i] = own.languages[int(found[at].argmax())], float(sure[at])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return source.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
