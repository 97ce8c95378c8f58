"""Delta Lloyd, polynomial fingerprints and periodic runs against plain versions."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import duckdb
import pytest

from metaenrich.llm import delta_lloyd, oracles, periodic_runs, poly_dedup, registry

ODD = "text string, other int, hi string, owner string, at string, id string, doc_id bigint"


def documents(spark, rows):
    return spark.createDataFrame([(t, 1, "h", "o", "a", "i", d) for d, t in rows], ODD)


# -- centroid clustering


def plain_lloyd(rows, k=8, rounds=10, dims=64, scale=1024):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: ((0, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()) if r[0] is not None else (1, ""), r[1]))
    centroids = [v for _, v in order[:k]]
    gap = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    assign = lambda: [min((gap(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        owners = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, n) in zip(kept, owners) if n == c]
            if own:
                centroids[c] = tuple(sum(x) // len(own) for x in zip(*own))
    last = assign()
    total = [sum(d for d, n in last if n == c) for c in range(len(centroids))]
    return sorted(((i, n, d, total[n], sum(total), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, last)), key=repr)


def clustered(frame, **options):
    return sorted(map(tuple, delta_lloyd.digest(delta_lloyd.cluster(frame, **options)).collect()), key=repr)


def vectors(seed, n, dims=64, spread=4):
    rng = random.Random(seed)
    centers = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(spread)]
    return [(i, [x + rng.gauss(0, 0.3) for x in rng.choice(centers)]) for i in range(n)]


def test_delta_lloyd_equals_plain_lloyd(spark):
    rows = vectors(1, 120)
    odd = [(500, None), (501, [0.0] * 63), (502, [0.0] * 65), (503, [None] + [0.0] * 63), (504, [float("nan")] + [0.0] * 63), (505, [float("inf")] + [0.0] * 63), (506, [])]
    again = [rows[0], rows[0], (None, rows[3][1]), (None, rows[5][1]), (7, rows[9][1])]
    frame = spark.createDataFrame([(i, v, "x", 3) for i, v in rows + odd + again], "vec_id bigint, embedding array<double>, v string, owner int")
    assert clustered(frame) == plain_lloyd(rows + odd + again)


def test_delta_lloyd_with_ties_and_empty_centroids(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.001, -0.001])] * 64) for i in range(40)]  # a few points, many times: equal and empty centroids
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    expected = plain_lloyd([(r.vec_id, r.embedding) for r in frame.collect()])
    assert clustered(frame) == expected and len({r[1] for r in expected}) < 8


def test_delta_lloyd_of_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<double>"
    assert clustered(spark.createDataFrame([], schema)) == []
    rows = vectors(3, 3)
    assert clustered(spark.createDataFrame(rows, schema)) == plain_lloyd(rows)
    with pytest.raises(Exception, match="beyond"):
        clustered(spark.createDataFrame([(1, [1e9] * 64)], schema))


def test_delta_lloyd_moves_fewer_vectors_each_round_than_it_has(spark):
    found = delta_lloyd.cluster(spark.createDataFrame(vectors(4, 300), "vec_id bigint, embedding array<double>"))
    moved = [m for _, m in found.rounds]
    assert moved[0] == 300 and max(moved[1:]) < 300 and moved[-1] < moved[1]


def test_delta_lloyd_equals_its_sql(spark, tables):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tables}/embeddings.parquet'")
    found = registry.op11_delta_lloyd(spark, tables)
    assert sorted(map(tuple, found.collect())) == sorted(con.sql(f"SELECT {', '.join(found.columns)} FROM ({oracles.op11()})").fetchall())


# -- exact duplicates


def plain_duplicates(rows):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    texts = [(i, (t or "").translate(low)) for i, t in rows]
    out, seen = [], set()
    for i, t in texts:
        same = [j for j, u in texts if u == t]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep and (t, i) not in seen, hashlib.sha256(t.encode()).hexdigest()))
        seen.add((t, i))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(6)
    words = ["alpha", "Beta", "GAMMA", "délta", "É", "ß", "\x00", "\n", "日本"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 80]))) for _ in range(60)]
    texts += [None, "", "", "\x00", "\x00\x00", "É", "é", "I", "ı", "K", "K", *[t.upper() for t in texts[:10]], *[t.lower() for t in texts[:25]], *texts[:20]]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "only here"), (None, "only here"), (3, texts[3]), (3, texts[3]), (3, "another text"), (4, "ANOTHER text")]
    return rows + [(1000 + i, "copy of many") for i in range(300)]


@pytest.mark.parametrize("options", [{}, {"huge": 40, "chunk": 7}, {"prime": 7}, {"prime": 3, "huge": 40, "chunk": 16}], ids=["plain", "huge texts in chunks", "fingerprints collide", "both"])
def test_duplicates_equal_a_plain_comparison(spark, options):
    rows = corpus()
    assert sorted(map(tuple, poly_dedup.duplicates(documents(spark, rows), **options).collect()), key=repr) == plain_duplicates(rows)


def test_duplicates_of_an_empty_table(spark):
    found = poly_dedup.duplicates(documents(spark, []))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and found.count() == 0


def test_fingerprints_compose_whatever_the_cuts():
    rng = random.Random(7)
    data = bytes(rng.randrange(256) for _ in range(5000))
    whole = poly_dedup.Fingerprint.of(data)
    for chunk in (1, 7, 64, 4999, 5000, 9000):
        found = poly_dedup.fingerprint(data, chunk=chunk)
        assert (found.value, found.length) == (whole.value, whole.length)
    cut = rng.randrange(5000)
    left, right = poly_dedup.Fingerprint.of(data[:cut]), poly_dedup.Fingerprint.of(data[cut:])
    assert (left.shifted(right.length) + right.value) % left.prime == whole.value


# -- periodic runs


def plain_runs(s, min_length=24, min_periods=3):
    out, n = {}, len(s)
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_periods * q):
                out.setdefault((i, j - i + q), q)
            i = max(i, j) + 1
    return sorted((a, length, q) for (a, length), q in out.items())


def repetitive(rng):
    s = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 90))]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(len(s)), rng.randrange(1, 9)
        s[a:a] = (s[a : a + p] * 70)[: rng.randrange(1, 70)]
    return s


def test_runs_equal_a_plain_search():
    rng, found = random.Random(8), 0
    for _ in range(500):
        s = repetitive(rng)
        ids = {c: n for n, c in enumerate(dict.fromkeys(s))}
        for min_length, min_periods in ((1, 3), (24, 3), (2, 2), (9, 4)):
            expected = plain_runs(s, min_length, min_periods)
            assert periodic_runs.stretch_runs([ids[c] for c in s], min_length, min_periods) == expected
            assert periodic_runs.word_runs([b"%d" % c for c in s], min_length, min_periods) == expected
            found += len(expected)
    assert found > 5000


def test_factors_are_the_longest_earlier_stretches():
    rng = random.Random(9)
    for _ in range(200):
        s, at = repetitive(rng)[:60], 0
        for start, length, source in periodic_runs.factors(s):
            longest = max([0, *[next((k for k in range(len(s) - start) if s[j + k] != s[start + k]), len(s) - start) for j in range(start)]])
            assert start == at and length == max(1, longest) and (source < 0) == (longest == 0)
            assert source < start and (source < 0 or s[source : source + length] == s[start : start + length])
            at += length
        assert at == len(s)


def plain_row(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    hashed = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, len(runs), *best, best[1] and 1000 * best[1] // best[2], hashed("".join("%d,%d,%d\n" % r for r in runs)), hashed(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_run_digests_equal_a_plain_search(spark):
    rng = random.Random(10)
    words = ["a", "b", "É", " x", "zz"]
    rows = [(i, "\t".join(words[c % 5] for c in repetitive(rng))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n "), (203, "x"), (None, "a b " * 40), (None, None), rows[0], rows[0], (204, "a " * 5000), (205, " ".join(str(i % 1700) for i in range(6000)))]
    found = registry.periodic_runs.digest(periodic_runs.find(documents(spark, rows), prepare=periodic_runs.stretched))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted((plain_row(i, t) for i, t in rows), key=repr) and sum(r[1] > 0 for r in got) > 30


def test_runs_of_the_given_documents(spark, tables):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    rows = [r for r in rows if len(r[1] or "") < 6000]
    assert sorted(map(tuple, registry.op13_periodic_runs(spark, tables).where("doc_id in (" + ",".join(str(i) for i, _ in rows) + ")").collect())) == sorted(plain_row(*r) for r in rows)


def test_runs_of_an_empty_table(spark):
    assert periodic_runs.digest(periodic_runs.find(documents(spark, []))).count() == 0
