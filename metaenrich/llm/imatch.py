"""I-Match document fingerprints, with DataFrame operations only.

Method: a document's terms are its distinct lower-cased words (by their 64-bit hashes). The lexicon keeps the terms
whose document frequency lies in a band (BAND, as shares of the documents; log(1/share) is the inverse document
frequency). Randomised subsets of the lexicon, LEXICONS at each of the fixed densities 2**-5, 2**-6, ... (levels 0 to
LEVELS, the same for all documents, each level's subsets inside those of the level before) give the signatures: the hash
of the sorted terms that the document has in that subset.

One density can't serve all lengths: a long document's signature would hang on hundreds of terms and break with any
edit, a short one would have none. So a fingerprint lists the signatures of all levels from the one on at which about
TERMS of its terms fall into each subset; every further level has half as many terms, so all of them together are about
twice the first. Likeness of two fingerprints: share of equal signatures among the subsets in which either has a term, at
the later of their first levels, which both list; so any two documents compare. A document without lexicon terms there
has the hash of its whole text as its only signature. Equal texts have equal fingerprints and likeness 1.

The lexicon is broadcast: it holds terms in at least BAND[0] of the documents, so at most (mean distinct terms a
document) / BAND[0] entries, whatever the number of documents; that bound is checked, and above MAX_LEXICON entries
the plan shuffles instead.

Null text counts as empty. The next document is the one with the next larger doc_id (of any type that has an order;
after the last: the first); repeated doc_ids follow each other in order of their texts' hashes, and rows that are equal in
both are alike anyway. Rows without doc_id sort first. An empty table gives an empty result; a single row is its own next
document. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, locate, shuffle_partitions

LEXICONS = 32
TERMS = 1.0
LEVELS = 14
BAND = (0.001, 0.35)
MAX_LEXICON = 2_000_000
#: Rows of an ordering range aimed at, and the most ranges.
RANGE_ROWS = 100_000
MAX_RANGES = 16_384
#: Ids of other types than whole numbers are ordered by ranges that this many of them, drawn by hash, divide.
SAMPLE_IDS = 20_000


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased words (letters and digits of any script)."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text: str, band: tuple[float, float] = BAND) -> DataFrame:
    """Terms (column t) within the band of document frequency."""
    total = docs.count()
    found = docs.select(F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    return found.where((F.col("df") >= F.lit(band[0] * total)) & (F.col("df") <= F.greatest(F.lit(band[1] * total), F.lit(1.0)))).select("t")


def _level(n: Column) -> Column:
    """Level at which about TERMS of n terms fall into each lexicon."""
    return F.least(F.greatest(F.round(F.log2(F.greatest(n, F.lit(1)) / F.lit(TERMS * LEXICONS))), F.lit(0)), F.lit(LEVELS)).cast("int")


def _choose(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds `name`_level and `name`_terms: the terms (t) that are in subset k of the text's first level, and the last level (d) at which they are.

    A term's draw is a hash of its own: the low bits name the subset, and with each zero bit that follows it stays one
    level longer. Step by step, so that a text is split once and its level is no expression inside a lambda.
    """
    every, level, terms_of = f"__{name}_terms", f"{name}_level", f"{name}_terms"
    rows = rows.withColumn(every, terms(F.col(text)))
    rows = rows.withColumn(level, _level(F.size(every)))
    drawn = F.transform(every, lambda t: F.struct(t.alias("t"), F.shiftrightunsigned(F.xxhash64(t, F.lit("lexicon")), 1).alias("h")))
    rest = lambda x: F.shiftrightunsigned(x["h"], 5)
    zeros = lambda x: F.least(F.bit_count(rest(x).bitwiseAND(-rest(x)) - 1), F.lit(LEVELS))
    in_level = F.filter(drawn, lambda x: zeros(x) >= F.col(level))
    return rows.withColumn(terms_of, F.transform(in_level, lambda x: F.struct(x["t"].alias("t"), F.pmod(x["h"], F.lit(LEXICONS)).cast("int").alias("k"), zeros(x).cast("int").alias("d")))).drop(every)


def _signatures(found: Column) -> Column:
    """Of terms (k, t) in order: two digits of each subset k that has any, and eight of the hash of its terms."""
    subsets = F.array_distinct(F.transform(found, lambda x: x["k"]))
    hashed = lambda k: F.xxhash64(F.transform(F.filter(found, lambda x: x["k"] == k), lambda x: x["t"]))
    digits = lambda v, n: F.lpad(F.lower(F.hex(v)), n, "0")
    return F.array_join(F.transform(subsets, lambda k: F.concat(digits(k.cast("long"), 2), digits(F.pmod(hashed(k), F.lit(1 << 32)), 8))), ",")


def _fingerprint(found: Column, level: Column, body_hash: Column) -> Column:
    """`level:signatures/signatures/...` of the levels from the first on, or `t:hash` of a text without lexicon terms."""
    last = F.array_max(F.transform(found, lambda x: x["d"]))
    lists = F.transform(F.sequence(level, F.greatest(last, level)), lambda i: _signatures(F.filter(found, lambda x: x["d"] >= i)))
    return F.when(F.coalesce(F.size(found), F.lit(0)) <= 0, F.concat(F.lit("t:"), F.lower(F.hex(body_hash)))).otherwise(F.concat(level.cast("string"), F.lit(":"), F.array_join(lists, "/")))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures at the first level that both fingerprints list; 0 to 1."""
    level = lambda f: F.substring_index(f, ":", 1).try_cast("int")
    lists = lambda f: F.split(F.substring_index(f, ":", -1), "/")
    pick = lambda f, other: F.filter(F.split(F.coalesce(F.get(lists(f), F.greatest(level(other) - level(f), F.lit(0))), F.lit("")), ","), lambda s: s != "")
    subsets = lambda signatures: F.transform(signatures, lambda s: F.substring(s, 1, 2))
    ours, theirs = pick(a, b), pick(b, a)
    share = F.try_divide(F.size(F.array_intersect(ours, theirs)).cast("double"), F.size(F.array_union(subsets(ours), subsets(theirs))).cast("double"))
    comparable = level(a).isNotNull() & level(b).isNotNull()
    return F.when(a == b, 1.0).otherwise(F.coalesce(F.when(comparable, share), F.lit(0.0)))


def _ranges(docs: DataFrame, key: str) -> Column:
    """Range of a key among sampled quantiles: the unit in which rows are ordered. Grows with the rows."""
    rows = docs.count()
    parts = max(1, min(MAX_RANGES, max(4 * shuffle_partitions(docs.sparkSession), rows // RANGE_ROWS)))
    if parts == 1 or not rows:
        cuts = []
    elif dict(docs.dtypes)[key] in ("tinyint", "smallint", "int", "bigint"):
        cuts = docs.agg(F.percentile_approx(F.col(key), [i / parts for i in range(1, parts)], 20_000)).first()[0] or []
    else:
        share = min(1.0, SAMPLE_IDS / rows)
        drawn = docs.select(F.col(key).alias("k")).where(F.col("k").isNotNull() & (F.pmod(F.xxhash64("k", F.lit("range")), F.lit(1 << 40)) < int(share * (1 << 40))))
        sample = sorted(r.k for r in drawn.distinct().limit(2 * SAMPLE_IDS).collect())
        cuts = [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []
    # Rows without an id come first, in ranges of their own by the hash of the text.
    empty = max(1, docs.where(F.col(key).isNull()).count() // RANGE_ROWS)
    first = F.least(F.floor((F.col("h0") / float(1 << 64) + 0.5) * empty), F.lit(empty - 1)) - empty
    return F.when(F.col(key).isNull(), first).otherwise(locate(F.col(key), sorted(set(cuts))).cast("long"))


def _next(rows: DataFrame, order: list[str], value: str, name: str, edge: DataFrame) -> DataFrame:
    """Adds the next row's `value`; edge (r, first) gives the one that follows the last row of each range."""
    inside = Window.partitionBy("r").orderBy(*[F.asc_nulls_first(c) for c in order])
    return rows.withColumn("__n", F.lead(F.col(value)).over(inside)).withColumn("__last", F.lead(F.lit(1)).over(inside).isNull()).join(F.broadcast(edge), "r", "left").withColumn(name, F.when(F.col("__last"), F.col("first")).otherwise(F.col("__n"))).drop("__n", "__last", "first")


def _edges(firsts: DataFrame) -> DataFrame:
    """(r, first): value of the first row of the next range with rows, around the end. As many rows as ranges."""
    order = Window.orderBy("r")
    start = firsts.agg(F.min_by("first", "r").alias("start"))
    return firsts.select("r", F.lead("first").over(order).alias("next")).crossJoin(F.broadcast(start)).select("r", F.coalesce("next", "start").alias("first"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "imatch")
    words = scratch.save(lexicon(docs, text), "lexicon")
    kept = F.broadcast(words) if words.count() <= MAX_LEXICON else words

    source = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    source = source.withColumn("h0", F.xxhash64("body")).withColumn("r", _ranges(docs, key))
    # First row of each range: one row a range.
    first = F.struct(F.col("doc_id").isNotNull().alias("b"), F.col("doc_id").alias("d"), F.col("h0").alias("h"))
    lows = source.groupBy("r").agg(F.min(first).alias("low"))
    heads = source.join(F.broadcast(lows), "r").where(first == F.col("low")).groupBy("r").agg(F.min("body").alias("first"))
    edge = scratch.save(_edges(heads), "edge")
    rows = _next(source, ["doc_id", "h0"], "body", "following", edge)
    n = F.length("body")
    swap = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("body"), F.lit(1), n - swap), F.substring(F.col("following"), F.lit(1), swap)))
    rows = _choose(_choose(rows.drop("following"), "body", "own"), "edited", "new")
    picked = rows.select(
        F.monotonically_increasing_id().alias("id"), "r", "doc_id", F.length("body").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "h0", F.xxhash64("edited").alias("h1"), "own_level", "own_terms", "new_level", "new_terms",
    )
    picked = scratch.save(picked, "picked")  # written, so the ids stay what they are

    # Terms outside the band go.
    tag = lambda c, v: F.transform(c, lambda x: F.struct(F.lit(v).alias("v"), x["t"].alias("t"), x["k"].alias("k"), x["d"].alias("d")))
    each = picked.select("id", F.explode(F.concat(tag("own_terms", 0), tag("new_terms", 1))).alias("x")).select("id", "x.*")
    band = each.join(kept, "t", "left_semi").groupBy("id").agg(F.collect_list(F.struct("v", "k", "t", "d")).alias("found"))
    # Sorted terms of each version, as columns: no lambda below repeats the sorting.
    of = lambda v: F.array_sort(F.transform(F.filter("found", lambda x: x["v"] == v), lambda x: F.struct(x["k"].alias("k"), x["t"].alias("t"), x["d"].alias("d"))))
    prints = picked.drop("own_terms", "new_terms").join(band, "id", "left").withColumns({"own": of(0), "new": of(1)})
    prints = prints.select("r", "doc_id", "n_chars", "edited_sha256", "h0", _fingerprint(F.col("own"), F.col("own_level"), F.col("h0")).alias("fingerprint"), _fingerprint(F.col("new"), F.col("new_level"), F.col("h1")).alias("edited_fingerprint"))
    prints = scratch.save(prints, "prints")
    scratch.drop("picked", "edge")
    heads = prints.groupBy("r").agg(F.min_by("fingerprint", first).alias("first"))
    out = _next(prints, ["doc_id", "h0"], "fingerprint", "next_fingerprint", _edges(heads))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
