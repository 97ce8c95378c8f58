"""Personal data by fixed patterns and a skip-chain conditional random field.

Base spans come from the four patterns of find_base(); they always stay. The field then labels further mentions: number-
and address-like stretches that no base span touches, such as a phone number that the pattern lost because a card number
follows it, one without its plus sign, a card number with dots, or an address with `(at)`.

Field: the mentions of a document, base ones included, are the nodes; the labels are O, email, ip, card, phone. A node's
potentials come from features of its form (digits, groups, separators, marks, Luhn sum, cue words before it). Chain
edges join neighbours that stand close together. Skip links tie all mentions of a document whose keys (digits, or
address without case) are equal, or end alike, to a hub of theirs; it pools the strongest evidence that any of them has
for each kind against one prior, and its message reaches each of them. So a prior isn't counted again with each repeat,
and the links grow with the mentions, not with their pairs. Chain and hub messages are passed in turn until nothing
changes any more (ROUNDS at most); a mention whose belief in a kind exceeds one half becomes a span.

Training: train() learns the potentials, chain and skip weights together by pseudo-likelihood with a Gaussian prior (mean
PRIOR, so that a corpus without mentions has a model too). Its examples are the mentions of about SAMPLE documents
(those with the smallest key hashes, EACH mentions of each at most), counted where they stand, so that only distinct
examples are collected. Base spans give the labels, other mentions are O. So that the field doesn't merely repeat the
patterns, each base mention is also shown with what the patterns look at masked (no plus sign, no Luhn sum, `(at)`), and
written in bare digits: once linked to the whole one, and once as an unlinked number that is O.

Null text counts as empty: no spans. Texts of any length are read whole in linear time; repeated rows each get their
row; an empty table gives an empty result. Columns other than key and text are ignored (redact() keeps them).
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of

KINDS = ("email", "ip", "card", "phone")
STATES = ("o", *KINDS)
#: Documents that train() looks at (expected number), and mentions of each.
SAMPLE = 20_000
EACH = 64
#: Distinct examples fitted on; the rarest ones beyond it are left out.
MAX_EXAMPLES = 20_000
#: Only a bound: messages settle within a few dozen rounds.
ROUNDS = 1000
#: Log potential of a base mention's kind.
CERTAIN = 8.0
CHAIN_GAP = 60
MIN_DIGITS = 7
RIDGE = 3.0
STEPS = 400

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_RUN = re.compile(r"(?<![A-Za-z0-9_.])[0-9]++(?![A-Za-z_])|(?<=[0-9][.])[0-9]++(?![A-Za-z_])")
_BETWEEN = re.compile(r"[ ().-]{1,3}")
_MARK = re.compile(r"@|\(at\)|\[at\]", re.I | re.A)
_HOST = re.compile(r" ?[A-Za-z0-9-]++(?:(?: ?(?:\(dot\)|\[dot\]) ?|\.)[A-Za-z0-9-]+)*", re.I | re.A)
#: Words that announce a kind, in the languages that documents have.
_CUES = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write to|courriel|correo|schreib)\W*$", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|adresse|serveur|servidor)\W*$", re.I),
    "card": re.compile(r"\b(?:card|visa|credit|account|karte|konto|carte|compte|tarjeta|cuenta)\W*$", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|fax|telefon|anruf|t[ée]l[ée]phone|tel[ée]fono|llame)\W*$", re.I),
}
Span = tuple[int, int, int]  # kind (index in KINDS), start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def find_base(text: str) -> list[Span]:
    """Pattern spans, by kind and then start; code points, end exclusive."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            out.append((0, start, done))
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text) is None:
        return out
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            parts = run[0].split(".")
            at = run.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                    out.append((1, at, end))
                at = end + 1
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = found[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, found.start(), found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in found[0]) <= 15:
                out.append((3, found.start(), found.end()))
    return out


def _candidates(text: str, base: list[Span]) -> list[tuple[int, int, bool]]:
    """(start, end, whether an address) of stretches that look like personal data and touch no base span, in order."""
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], sorted(b for _, b in taken)
    # Whether a stretch touches a base span: as many of them end before it as begin before its end, or not.
    free = lambda a, b: bisect_left(starts, b) == bisect_left(ends, a + 1)
    found: list[tuple[int, int, bool]] = []
    done = 0
    for mark in _MARK.finditer(text):
        host = _HOST.match(text, mark.end())
        start = mark.start() - (mark.start() > done and text[mark.start() - 1] == " ")
        end = start
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if host and start < end and mark.start() >= done:
            done = host.end()
            found.append((start, done, True))
    runs: list[tuple[int, int]] = []

    def close() -> None:
        if sum(b - a for a, b in runs) >= MIN_DIGITS:
            a, b = runs[0][0], runs[-1][1]
            a -= a > 0 and text[a - 1] == "(" and ")" in text[a:b]
            found.append((a - (a > 0 and text[a - 1] == "+"), b, False))
        runs.clear()

    for run in _RUN.finditer(text):
        a, b = run.span()
        if not free(a, b):
            close()
            continue
        if runs:
            digits, quads = sum(y - x for x, y in runs) + b - a, all(y - x == 4 for x, y in runs)
            joined = _BETWEEN.fullmatch(text, runs[-1][1], a) and free(runs[-1][1], a)
            longest, blank = max(b - a, runs[-1][1] - runs[-1][0]), " " in text[runs[-1][1] : a]
            if not joined or longest >= (7 if blank else 12) or digits > (19 if quads and b - a <= 4 else 15):
                close()
        runs.append((a, b))
    close()
    out, end = [], 0
    for a, b, address in sorted(found):
        if a >= end and free(a, b):
            out.append((a, b, address))
            end = b
    return out


def _key(raw: str, address: bool) -> str:
    return re.sub(r"\W+", "", re.sub(r"[(\[]at[)\]]|[(\[]dot[)\]]", "", raw.lower())) if address else "".join(c for c in raw if "0" <= c <= "9")


_NAMES = (
    "bias number address plus paren dash dot blank d7 d8-9 d10 d11 d12-13 d14-15 d16 d17-19 d20 run1 run2 run3 run4 run5 quads ipform ipgood ipbad luhn noluhn"
    " at spelled host cue_email cue_ip cue_card cue_phone"
).split()
FEATURES = {name: i for i, name in enumerate(_NAMES)}
_DIGIT_CLASSES = ((7, "d7"), (9, "d8-9"), (10, "d10"), (11, "d11"), (13, "d12-13"), (15, "d14-15"), (16, "d16"), (19, "d17-19"))


def features_of(raw: str, address: bool, before: str = "") -> frozenset[str]:
    """Features of a mention's form, and the cues in what stands before it."""
    out = {"bias"}
    if address:
        out |= {"address", "at" if "@" in raw else "spelled"}
        if re.search(r"(?:\.|[(\[]dot[)\]] ?)[A-Za-z0-9-]", raw.rpartition("@")[2], re.I):
            out.add("host")
    else:
        runs = re.findall("[0-9]+", raw)
        digits = "".join(runs)
        n = len(digits)
        out |= {"number", next((name for most, name in _DIGIT_CLASSES if n <= most), "d20"), f"run{min(5, len(runs))}"}
        out |= {name for mark, name in (("+", "plus"), ("(", "paren"), ("-", "dash"), (".", "dot"), (" ", "blank")) if mark in raw}
        if len(runs) >= 4 and all(len(r) == 4 for r in runs[:4]):
            out.add("quads")
        if raw.count(".") == len(runs) - 1 == 3:
            out |= {"ipform", "ipgood" if all(len(r) <= 3 and int(r) <= 255 for r in runs) else "ipbad"}
        if 13 <= n <= 19:
            out.add("luhn" if luhn(digits) else "noluhn")
    out |= {f"cue_{kind}" for kind, cue in _CUES.items() if before and cue.search(before)}
    return frozenset(out)


def _prior() -> np.ndarray:
    """Means of the potentials: features x labels, in terms of plain expectation."""
    w = np.zeros((len(_NAMES), len(STATES)))
    put = lambda name, *values: w.__setitem__(FEATURES[name], values)
    put("bias", 2.0, 0, 0, 0, 0)
    put("number", 0, -9, -3, -2, -1)
    put("address", 0, 0, -9, -9, -9)
    put("spelled", 0, 2, 0, 0, 0)
    put("host", 0, 1, 0, 0, 0)
    put("ipform", 0, 0, 3, 0, -2)
    put("ipgood", 0, 0, 2, 0, 0)
    put("plus", 0, 0, 0, -2, 2)
    put("paren", 0, 0, 0, -2, 2)
    put("dash", 0, 0, 0, 0, 0.5)
    put("luhn", 0, 0, 0, 4, 0)
    put("noluhn", 1, 0, 0, -3, 0)
    put("d16", 0, 0, 0, 1, -3)
    put("d17-19", 0, 0, 0, 0, -3)
    put("d20", 3, 0, 0, 0, -3)
    for i, kind in enumerate(KINDS):
        w[FEATURES[f"cue_{kind}"], i + 1] = 2.5
    return w


@dataclass
class Field:
    """Log potentials: features x labels, chain labels x labels (symmetric), and of equal and of similar keys."""

    unary: np.ndarray
    chain: np.ndarray
    same: float
    near: float

    @staticmethod
    def prior() -> Field:
        return Field(_prior(), 0.1 * np.eye(len(STATES)), 7.5, 6.0)

    def potentials(self, found: frozenset[str]) -> np.ndarray:
        return self.unary[[FEATURES[f] for f in found]].sum(axis=0)


def _message(evidence: np.ndarray, weight: float) -> np.ndarray:
    """Log message of hubs with this evidence (rows) over a link that favours equal labels by `weight`."""
    p = np.exp(evidence - evidence.max(axis=-1, keepdims=True))
    p /= p.sum(axis=-1, keepdims=True)
    return np.log(p * (np.exp(weight) - 1) + 1)


class Hubs:
    """Hubs of a document's keys: which mentions belong to each, and which hubs end alike."""

    def __init__(self, keys: list[tuple[bool, str]]):
        number: dict[tuple[bool, str], int] = {}
        of = np.array([number.setdefault(k, len(number)) if k[1] else -1 for k in keys], np.int64)
        self.members = np.flatnonzero(of >= 0)
        self.of = of[self.members]
        self.count = np.bincount(self.of, minlength=len(number))
        alike: dict[str, int] = {}
        ending = np.full(len(number), -1)
        for (address, text), hub in number.items():
            if not address and len(text) >= MIN_DIGITS:
                ending[hub] = alike.setdefault(text[-MIN_DIGITS:], len(alike))
        self.ended = np.flatnonzero(ending >= 0)
        self.ending = ending[self.ended]
        self.any = bool((self.count > 1).any() or (np.bincount(self.ending) > 1).any())

    def messages(self, local: np.ndarray, field: Field) -> np.ndarray:
        """What each mention hears: from other hubs that end alike, and from its own hub if that has several mentions."""
        out = np.zeros_like(local)
        evidence = np.full((len(self.count), local.shape[1]), -np.inf)
        np.maximum.at(evidence, self.of, local[self.members])
        heard = np.zeros_like(evidence)
        if len(self.ended):
            # The strongest evidence of the other hubs with this ending: the largest, or for its owner the second.
            own = evidence[self.ended]
            first, second = (np.full((self.ending.max() + 1, own.shape[1]), -np.inf) for _ in range(2))
            np.maximum.at(first, self.ending, own)
            times = np.zeros_like(first)
            top = own == first[self.ending]
            np.add.at(times, self.ending, top)
            np.maximum.at(second, self.ending, np.where(top, -np.inf, own))
            others = np.where(top & (times[self.ending] < 2), second[self.ending], first[self.ending])
            several = np.bincount(self.ending)[self.ending] > 1
            heard[self.ended[several]] = _message(others[several], field.near)
        mine = _message(evidence + heard, field.same)
        mine[self.count < 2] = 0
        out[self.members] = heard[self.of] + mine[self.of]
        return out


def beliefs(unary: np.ndarray, edges: np.ndarray, field: Field, hubs: Hubs | None = None, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals of the nodes by loopy sum-product over chain edges (i, j), in turn with the messages of the hubs."""
    edges = np.asarray(edges, np.int64).reshape(-1, 2)
    a, b = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    back = np.roll(np.arange(len(a)), len(edges))
    chain = np.exp(field.chain)
    sent = np.zeros((len(a), unary.shape[1]))
    told = np.zeros_like(unary)
    for _ in range(rounds):
        came = np.zeros_like(unary)
        np.add.at(came, b, sent)
        new_told = hubs.messages(unary + came, field) if hubs is not None else told
        out = (unary + new_told + came)[a] - sent[back]
        new = np.log(np.exp(out - out.max(axis=1, keepdims=True, initial=-np.inf)) @ chain)
        new -= new.mean(axis=1, keepdims=True)
        change = max(np.abs(new - sent).max(initial=0), np.abs(new_told - told).max(initial=0))
        sent, told = 0.5 * sent + 0.5 * new, new_told
        if change < 1e-4:
            break
    came = np.zeros_like(unary)
    np.add.at(came, b, sent)
    total = unary + told + came
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


@dataclass
class _Mentions:
    """The nodes of a document in order: start, end, kind of a base span or None, whether an address, raw text."""

    nodes: list[tuple[int, int, int | None, bool]]
    raw: list[str]
    before: list[str]
    edges: list[tuple[int, int]]

    @staticmethod
    def of(text: str, base: list[Span], extra: list[tuple[int, int, bool]]) -> _Mentions:
        nodes = sorted([(a, b, k, k == 0) for k, a, b in base] + [(a, b, None, d) for a, b, d in extra], key=lambda n: n[:2])
        edges = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1][0] - nodes[i][1] <= CHAIN_GAP]
        return _Mentions(nodes, [text[a:b] for a, b, _, _ in nodes], [text[max(0, a - 16) : a] for a, *_ in nodes], edges)

    def keys(self) -> list[tuple[bool, str]]:
        return [(address, _key(raw, address)) for (*_, address), raw in zip(self.nodes, self.raw, strict=True)]


def find_more(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans that the field adds to the base spans."""
    extra = _candidates(text, base)
    if not extra:
        return []
    found = _Mentions.of(text, base, extra)
    unary = np.array([field.potentials(features_of(raw, n[3], before)) for n, raw, before in zip(found.nodes, found.raw, found.before, strict=True)])
    for i, (_, _, kind, _) in enumerate(found.nodes):
        if kind is not None:
            unary[i] = 0
            unary[i, kind + 1] = CERTAIN
    hubs = Hubs(found.keys())
    belief = beliefs(unary, np.array(found.edges, np.int64), field, hubs if hubs.any else None)
    best = belief.argmax(axis=1)
    return [(int(k) - 1, a, b) for (a, b, kind, _), k, p in zip(found.nodes, best, belief, strict=True) if kind is None and k and p[k] > 0.5]


#: Features, label, label of the linked mention (0: none), whether only the ending is equal, labels of the neighbours.
Example = tuple[frozenset, int, int, bool, tuple]


def examples(text: str) -> list[Example]:
    """Training examples of a document: its mentions as they are, and its base mentions masked and in bare digits."""
    base = find_base(text)
    found = _Mentions.of(text, base, _candidates(text, base)[:EACH])
    labels = [0 if n[2] is None else n[2] + 1 for n in found.nodes]
    beside: dict[int, list[int]] = {}
    for i, j in found.edges:
        beside.setdefault(i, []).append(labels[j])
        beside.setdefault(j, []).append(labels[i])
    stand: dict[tuple[bool, str], list[int]] = {}
    for key, label in zip(found.keys(), labels, strict=True):
        stand.setdefault(key, []).append(label)
    out: list[Example] = []
    for i, (n, raw, before, key) in enumerate(zip(found.nodes[:EACH], found.raw, found.before, found.keys(), strict=False)):
        label, near = labels[i], tuple(sorted(beside.get(i, [])))
        whole = features_of(raw, n[3], before)
        others = max(stand[key]) if len(stand[key]) > 1 else 0
        out.append((whole, label, others, False, near))
        if n[3]:
            if label:
                masked = features_of(raw.replace("@", " (at) "), True, before)
                out += [(masked, label, 0, False, near), (masked, label, label, False, near)]
            continue
        out.append((whole - {"plus", "luhn", "noluhn", "ipgood", "ipbad"}, label, others, False, near))
        if label == 4:
            bare = features_of(key[1], False)
            out += [(bare, label, label, False, near), (bare, label, label, True, near), *[(bare, 0, 0, False, near)] * 2]
    return out


def fit(counted: list[tuple[Example, int]], steps: int = STEPS) -> Field:
    """Maximum pseudo-likelihood with a Gaussian prior, by Adam on all examples at once."""
    prior = Field.prior()
    if not counted:
        return prior
    states, every = len(STATES), [e for e, _ in counted]
    weight = np.array([n for _, n in counted], np.float64)
    x = np.zeros((len(every), len(_NAMES)))
    y = np.array([e[1] for e in every])
    same, near, beside = (np.zeros((len(every), states)) for _ in range(3))
    for i, (found, _, other, ending, neighbours) in enumerate(every):
        x[i, [FEATURES[f] for f in found]] = 1
        if other:
            (near if ending else same)[i, other] = 1
        for label in neighbours:
            beside[i, label] += 1
    # Labels weigh the inverse root of their frequency.
    share = np.bincount(y, weight, states)
    weight = weight / np.sqrt(np.maximum(share[y], 1))
    weight *= min(share.sum(), 2000) / weight.sum()
    start = np.concatenate([prior.unary.ravel(), prior.chain.ravel(), [prior.same, prior.near]])
    theta, mean, var = start.copy(), np.zeros_like(start), np.zeros_like(start)
    target = np.eye(states)[y]
    cut = len(_NAMES) * states
    for step in range(1, steps + 1):
        unary, chain = theta[:cut].reshape(-1, states), theta[cut:-2].reshape(states, states)
        score = x @ unary + beside @ chain + theta[-2] * same + theta[-1] * near
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        miss = (p - target) * weight[:, None]
        pull = beside.T @ miss
        grad = np.concatenate([(x.T @ miss).ravel(), ((pull + pull.T) / 2).ravel(), [(same * miss).sum(), (near * miss).sum()]])
        grad += RIDGE * (theta - start)
        mean, var = 0.9 * mean + 0.1 * grad, 0.99 * var + 0.01 * grad**2
        theta -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-6)
    return Field(theta[:cut].reshape(-1, states), theta[cut:-2].reshape(states, states), float(theta[-2]), float(theta[-1]))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """The field of a corpus, learned from about `sample` of its documents; the prior if they hold no mention."""
    total = docs.count()
    if not total:
        return Field.prior()
    least = F.pmod(F.xxhash64(F.col(key), F.lit("pii")), F.lit(1 << 40)) < int(min(1.0, sample / total) * (1 << 40))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for (body,) in rows_of(batches, "text"):
            if body:
                for found, *rest in examples(body):
                    seen[pickle.dumps((sorted(found), *rest))] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["example", "n"])

    drawn = docs.where(least).select(F.col(text).alias("text"))
    counted = drawn.mapInArrow(run, "example binary, n bigint").groupBy("example").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "example").limit(MAX_EXAMPLES).collect()
    return fit([((frozenset(found), *rest), r.n) for r in counted for found, *rest in [pickle.loads(bytes(r.example))]])


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind and then start."""
    base = find_base(text)
    return base, sorted(base + find_more(text, base, field))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base counts, and the spans: base and all, as `kind:start:end` joined by commas. No shuffle."""
    id_type = dict(docs.dtypes)[key]
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            bases, spans = [], []
            for (body,) in rows_of([batch], "text"):
                base, every = find(body or "", field)
                for k, column in enumerate(counts):
                    column.append(sum(s[0] == k for s in base))
                bases.append(_joined(base))
                spans.append(_joined(every))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(bases, pa.string()), pa.array(spans, pa.string())], names)

    schema = f"doc_id {id_type}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base string, spans string"
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """The counts, base_sha256 and spans of a detect() result."""
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def mask(text: str, field: Field) -> str:
    """The text with each span as [KIND]; where spans overlap, the first (then longest) stands for all."""
    _, spans = find(text, field)
    if not spans:
        return text
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """docs with masked texts, all columns and rows kept; `length`, if there, is the masked text's. Null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                at = part.schema.get_field_index(text)
                masked = [None if t is None else mask(t, field) for t in part.column(at).to_pylist()]
                yield part.set_column(at, part.schema.field(at), pa.array(masked, part.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if length in docs.columns:
        out = out.withColumn(length, F.coalesce(F.length(text), F.lit(0)).cast(docs.schema[length].dataType))
    return out
