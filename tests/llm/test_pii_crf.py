"""The skip-chain field: exact on trees, learned from the given table, and decided by its edges where forms aren't enough."""

import itertools
import random
import time
from dataclasses import replace

import numpy as np
import pytest

from metaenrich.llm import pii_crf
from tests.llm.test_small import empty, frame


@pytest.fixture(scope="module")
def learned(spark):
    """A field learned on the documents with even ids, and the others' texts."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return pii_crf.train(docs.where("doc_id % 2 = 0")), [r.text or "" for r in docs.where("doc_id % 2 = 1").orderBy("doc_id").collect()]


def without_edges(field):
    return replace(field, chain=np.zeros_like(field.chain), same=0.0, near=0.0)


def test_beliefs_of_a_tree_are_exact():
    rng = np.random.default_rng(1)
    unary, edges = rng.normal(size=(4, 5)), [(0, 1), (1, 2), (1, 3)]
    chain = rng.normal(size=(5, 5))
    field = replace(pii_crf.Field.prior(), chain=chain + chain.T)
    exact = np.zeros((4, 5))
    for states in itertools.product(range(5), repeat=4):
        weight = np.exp(sum(unary[i, s] for i, s in enumerate(states)) + sum(field.chain[states[a], states[b]] for a, b in edges))
        for i, s in enumerate(states):
            exact[i, s] += weight
    exact /= exact.sum(axis=1, keepdims=True)
    assert np.allclose(pii_crf.beliefs(unary, edges, field), exact, atol=1e-3)


def test_the_gradient_leads_to_the_optimum():
    """No single change of a potential improves the penalized pseudo-likelihood that fit() ends at."""
    counted = [((frozenset(["bias", "number", "d10"]), 4, 4, False, (4,)), 9), ((frozenset(["bias", "number", "d10"]), 0, 0, False, (0, 4)), 30), ((frozenset(["bias", "number", "plus"]), 4, 0, False, ()), 12)]
    field = pii_crf.fit(counted, steps=3000)
    prior = pii_crf.Field.prior()
    share = np.bincount([e[1] for e, _ in counted], [n for _, n in counted], 5)
    weight = np.array([n / np.sqrt(share[e[1]]) for e, n in counted])
    weight *= share.sum() / weight.sum()

    def loss(f):
        total = 0.0
        for ((found, label, other, ending, beside), _), w in zip(counted, weight, strict=True):
            score = f.potentials(found) + sum((f.chain[k] for k in beside), np.zeros(5))
            if other:
                score[other] += f.near if ending else f.same
            total -= w * (score[label] - np.log(np.exp(score).sum()))
        change = [(f.unary - prior.unary).ravel(), (f.chain - prior.chain).ravel(), [f.same - prior.same, f.near - prior.near]]
        return total + pii_crf.RIDGE / 2 * sum(x * x for part in change for x in part)

    least = loss(field)
    for d in (-0.1, 0.1):
        assert loss(replace(field, same=field.same + d)) > least
        for name in ("bias", "d10", "plus"):
            moved = field.unary.copy()
            moved[pii_crf.FEATURES[name], 4] += d
            assert loss(replace(field, unary=moved)) > least


def test_lost_numbers_of_the_given_table_are_found(learned):
    """A phone number that the pattern loses because digits follow it, a card number behind another number."""
    field, texts = learned
    field_on_all = field
    added = [(text[a:b], pii_crf.KINDS[k]) for text in texts for k, a, b in pii_crf.find(text, field_on_all)[1] if (k, a, b) not in pii_crf.find_base(text)]
    assert added and all(raw.startswith("+1 (") if kind == "phone" else pii_crf.luhn(raw) for raw, kind in added)


def planted(texts, rng, n=200):
    """(text, true added stretches): personal data in forms that no pattern knows, among numbers that are none."""
    out = []
    for text in rng.sample([t for t in texts if 50 < len(t) < 5000], n):
        phone = f"+{rng.randrange(1, 99)} ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        digits = "".join(c for c in phone if c.isdigit())
        kind = rng.randrange(5)
        variant = [digits, digits[-10:], phone[1:], f"jo.{rng.randrange(99)} (at) mail{rng.randrange(9)} (dot) example (dot) org", None][kind]
        if kind == 4:
            body = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
            whole = next(body + str(c) for c in range(10) if pii_crf.luhn(body + str(c)))
            variant = ".".join(whole[i : i + 4] for i in range(0, 16, 4))
        number = str(rng.randrange(10**9, 10**10))
        words = text.split()
        cut = len(words) // 2
        parts = [" ".join(words[:cut]), phone if kind < 3 else "", " ".join(words[cut:]), f"no. {number} again {number}", variant, "end"]
        out.append((" ".join(p for p in parts if p), variant, number))
    return out


def test_planted_variants_are_found_through_the_edges(learned):
    field, texts = learned
    cases = planted(texts, random.Random(11))

    def measure(f):
        hit = wrong = told = 0
        for text, variant, number in cases:
            added = [text[a:b] for k, a, b in pii_crf.find(text, f)[1] if (k, a, b) not in pii_crf.find_base(text)]
            hit += variant in [x.strip() for x in added]
            wrong += number in added
            told += len(added)
        return hit / len(cases), wrong, told

    recall, wrong, told = measure(field)
    assert recall >= 0.9 and wrong == 0 and told <= 1.1 * len(cases)
    assert measure(without_edges(field))[0] <= recall - 0.2  # bare digits are told by their links alone


def test_offsets_of_letters_that_grow_in_lower_case(learned):
    text = "\u0130" * 400 + " mail: joe (at) example (dot) org"
    for field in (learned[0], pii_crf.Field.prior()):
        assert [text[a:b] for _, a, b in pii_crf.find(text, field)[1]] == ["joe (at) example (dot) org"]
    long = f"{'a' * 90} (at) {'b' * 90} (dot) org"
    assert pii_crf.mask(f"x {long} y", learned[0]) == "x [EMAIL] y"


@pytest.mark.parametrize("text", ["1 " * 200_000, "12345678 " * 30_000, "a (at) " * 50_000, "a@" * 100_000, "+1 (017) 555-7713 and 0175557713; " * 5000, "5" * 300_000, "1.2.3." * 50_000], ids=str)
def test_long_texts_take_linear_time(text, learned):
    began = time.process_time()
    pii_crf.find(text, learned[0])
    assert time.process_time() - began < 30


def test_training_on_tables_without_mentions(spark):
    for docs in (empty(spark), frame(spark, [(1, None), (2, ""), (3, "words only")])):
        assert np.array_equal(pii_crf.train(docs).unary, pii_crf.Field.prior().unary)
