"""The trained models against exact solutions and plain readings, and on odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from metaenrich.llm import langid, ordinal
from tests.llm.test_small import empty, frame, prose


def test_the_ordinal_fit_is_a_maximum():
    """No single change of a weight or threshold improves the penalized likelihood; probabilities are those of the model."""
    rng = np.random.default_rng(3)
    grades = rng.integers(0, 3, 300)
    rows = [(np.array([1, 2, 3]), np.array([1.0, g + rng.normal(), rng.normal()])) for g in grades]
    ridge = 1e-2
    model = ordinal.fit(rows, grades, steps=4000, ridge=ridge)
    weight = 1 / np.sqrt(np.bincount(grades, minlength=3)[grades] / len(grades))
    weight /= weight.sum()

    def loss(weights, cuts):
        scores = np.array([weights[s] @ v for s, v in rows])
        tail = 1 / (1 + np.exp(-(scores[:, None] - cuts)))
        upper = np.column_stack([np.ones(len(rows)), tail, np.zeros(len(rows))])
        chance = upper[np.arange(len(rows)), grades] - upper[np.arange(len(rows)), grades + 1]
        return -(weight * np.log(chance)).sum() + ridge / 2 * (weights**2).sum()

    least = loss(model.weights.astype(np.float64), model.cuts)
    for d in (-0.05, 0.05):
        for slot in (1, 2, 3):
            moved = model.weights.astype(np.float64)
            moved[slot] += d
            assert loss(moved, model.cuts) > least
        for i in range(2):
            cuts = model.cuts.copy()
            cuts[i] += d
            assert loss(model.weights.astype(np.float64), cuts) > least
    assert model.weights[2] > 0.5 and model.cuts[0] < model.cuts[1]


def test_a_repeated_label_counts_once(spark):
    docs = frame(spark, [(i % 3, prose(random.Random(i), 30)) for i in range(60)])
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, 1, 1), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    seen = []
    fitted, ordinal.fit = ordinal.fit, lambda rows, grades: seen.append((len(rows), sorted(grades.tolist()))) or fitted(rows, grades)
    try:
        ordinal.train(docs, labels)
        ordinal.train(docs, labels, sample=2)
    finally:
        ordinal.fit = fitted
    assert seen[0] == (3, [0, 1, 2]) and seen[1][0] == 2


def test_long_and_odd_texts_are_graded(spark):
    docs = frame(spark, [(1, "word " * 300_000), (2, "x" * 2_000_000), (3, None), (4, ""), (5, "a b")])
    labels = spark.createDataFrame([(5, 1, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int")
    out = ordinal.score(docs, ordinal.train(docs, labels)).collect()
    assert len(out) == 6 and all(0 <= r.p_good <= r.p_not_low <= 1 for r in out)


# --- languages


def slots_of(text):
    """Slots of all n-grams, one by one."""
    points = langid._fold(f" {text} ").tolist()
    out = set()
    for n in range(1, langid.MAX_GRAM + 1):
        for i in range(len(points) - n + 1):
            h = 0
            for m in range(1, n + 1):
                h = (h * 0x01000193 + (points[i + m - 1] + int(langid._SALTS[m])) % (1 << 32) * int(langid._SALTS[0])) % (1 << 32)
            out.add(((h ^ (h >> 15)) * 0x2C1B3C6D) % (1 << 32) >> (32 - langid.DIMS.bit_length() + 1))
    return out


def test_presence_equals_a_plain_reading(monkeypatch):
    for text in ("Straße, 12 Äpfel!", "a", "", "日本語 text", "x" * 500 + " end"):
        whole = np.zeros(langid.DIMS, np.uint8)
        langid.mark(text, whole)
        assert set(np.flatnonzero(whole).tolist()) == slots_of(text)
        with monkeypatch.context() as patch:
            patch.setattr(langid, "_BLOCK_CHARS", 7)  # texts of several blocks
            parts = np.zeros(langid.DIMS, np.uint8)
            langid.mark(text, parts)
        assert np.array_equal(whole, parts)


def test_all_rows_as_landmarks_give_exact_ridge_regression():
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcd " if i % 2 else "wxyz ", k=60)) + "shared words " * (i % 3) for i in range(40)]
    bits = []
    for text in texts:
        row = np.zeros(langid.DIMS, np.uint8)
        langid.mark(text, row)
        bits.append(np.packbits(row).tobytes())
    labels = ["p" if i % 2 or i % 5 == 0 else "q" for i in range(40)]
    model = langid.fit(bits, labels, landmarks=40, ridge=0.1)
    presence = np.stack([np.unpackbits(np.frombuffer(b, np.uint8)) for b in bits]).astype(np.float64)
    kernel = presence @ presence.T / np.sqrt(np.outer(presence.sum(1), presence.sum(1)))
    own = np.array([0 if x == "p" else 1 for x in labels])
    target = np.where(own[:, None] == np.arange(2), 1.0, -1.0)
    share = 1 / np.bincount(own)[own]
    share *= len(labels) / share.sum()
    exact = kernel @ np.linalg.solve(share[:, None] * kernel + 0.1 * np.eye(40), share[:, None] * target)
    assert np.allclose(model.scores(presence.astype(np.float32)), exact, atol=1e-3)


def test_rows_without_id_and_repeated_rows(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("abcd " if i % 2 else "wxyz ", k=80)), "p" if i % 2 else "q") for i in range(200)]
    rows += [(None, rows[0][1], "p"), rows[1], rows[1]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = langid.predict(docs, langid.train(docs)).collect()
    assert len(out) == 203 and [(r.held_out, r.lang_pred) for r in out if r.doc_id is None] == [(True, "q")]
    assert len({tuple(r) for r in out if r.doc_id == 1}) == 1
    assert langid.predict(empty(spark).select("doc_id", "text", F.lit("x").alias("lang")), None).collect() == []
