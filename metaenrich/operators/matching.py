"""Fuzzy match of free text to a controlled vocabulary."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.scratch import Scratch
from .name_index import NameIndex
from .rules import Rules

#: References that are compared one by one; it decides how matches are found, not which.
LITERALS = 256
REDUNDANT = "redundant"
NO_MATCH = "no_match"

_SPACE = re.compile(r"\s+")


def normalized(text: str, typos: dict[str, str]) -> str:
    """functions.text.normalize for driver-side values (the vocabulary: short ASCII strings)."""
    cleaned = re.sub(T.PUNCTUATION, " ", text.lower())
    return "".join(typos.get(w, w) for w in _SPACE.split(cleaned) if w)


def vocabulary(rules: Rules) -> dict[str, str]:
    """Normalized reference to its original, in order of the normalized form; the last original wins."""
    found = {normalized(v, rules.typo_corrections): v for v in rules.reference_values}
    return dict(sorted(found.items(), key=lambda kv: kv[0].encode()))


def _by_literals(rows: DataFrame, known: dict[str, str], threshold: float) -> DataFrame:
    """rows with __match: the vocabulary stands in the expression, each text is compared with all references."""
    table, key = T.string_map(known), F.col("__key")
    rows = rows.withColumn("__exact", F.coalesce(F.try_element_at(table, key), F.try_element_at(table, F.col("__joined"))))
    refs = F.array(*map(F.lit, known)) if known else F.array().cast("array<string>")
    rated = F.filter(F.transform(refs, lambda r: F.struct((-T.similarity(key, r)).alias("d"), r.alias("r"))), lambda s: (-s["d"] > 0) & (-s["d"] >= F.lit(threshold)))
    # Similarities are computed only for texts without an exact hit.
    nearest = F.when(F.col("__exact").isNull(), F.array_min(rated)["r"])
    return rows.withColumn("__near", nearest).withColumn("__match", F.coalesce("__exact", F.try_element_at(table, F.col("__near")))).drop("__exact", "__near")


def _by_index(rows: DataFrame, known: dict[str, str], threshold: float, path: str | None) -> DataFrame:
    """The same for a vocabulary of any size: exact keys by joins, similar references by an index of them."""
    spark = rows.sparkSession
    table = spark.createDataFrame(list(known.items()), "ref string, original string")
    hit = lambda key, name: table.select(F.col("ref").alias(key), F.col("original").alias(name))
    rows = rows.join(hit("__key", "__first"), "__key", "left").join(hit("__joined", "__second"), "__joined", "left")
    rows = rows.withColumn("__exact", F.coalesce("__first", "__second")).drop("__first", "__second")
    forms = rows.where("__exact is null and __key <> ''").select(F.col("__key").alias("input"), F.col("__key").alias("form")).distinct()
    # Of equally similar names the index gives the one with the smallest id: here the reference itself.
    index = NameIndex.of(table.select(F.col("ref").alias("name"), F.col("ref").alias("id")), path or Scratch(spark, "vocabulary").path("index"), threshold)
    near = index.similar(forms).select(F.col("input").alias("__key"), F.col("id").alias("ref")).join(table, "ref").select("__key", F.col("original").alias("__near"))
    return rows.join(near, "__key", "left").withColumn("__match", F.coalesce("__exact", "__near")).drop("__exact", "__near")


def rate(values: DataFrame, column: str, rules: Rules, path: str | None = None) -> DataFrame:
    """values with matched and outcome (null for a match, else `redundant` or `no_match`).

    First hit wins: exact key, key of the text without white space, most similar reference at the threshold. Equal
    similarities go to the smaller normalized reference. Exclusions are tested with the exact key in every case.
    Keys stand in columns of their own, so that they are computed once a row and not once a reference. Vocabularies of
    more than LITERALS references are looked up in an index, which is kept at `path` for later runs.
    """
    known = vocabulary(rules)
    text, key = F.col(column), F.col("__key")
    rows = values.withColumn("__key", T.normalize(text, rules.typo_corrections))
    rows = rows.withColumn("__joined", F.when(F.size(T.words(text)) > 1, T.normalize(T.squeeze(text), rules.typo_corrections)))
    # Without a threshold any common letter is a match: there is nothing to index.
    indexed = len(known) > LITERALS and rules.threshold > 0
    rows = _by_index(rows, known, rules.threshold, path) if indexed else _by_literals(rows, known, rules.threshold)
    matched = F.col("__match")
    redundant = F.lit(False)
    for e in rules.redundancy_exclusions:
        redundant = redundant | (key.isin(list(e.normalized)) & matched.isin(list(e.matches)))
    outcome = F.when(matched.isNull(), NO_MATCH).when(redundant, REDUNDANT)
    # Out of a generator: the optimizer would move a filter on the outcome below a distinct of the texts, and rate every row.
    rated = F.inline(F.array(F.struct(F.when(outcome.isNull(), matched).alias("matched"), outcome.alias("outcome"))))
    return rows.select(*values.columns, rated)


def match_distinct(rows: DataFrame, column: str, rules: Rules, path: str | None = None) -> DataFrame:
    """(column, matched, outcome) for the distinct values of a column.

    Similarities cost far more than a distinct, so every value is rated once however often it occurs.
    """
    return rate(rows.select(column).distinct(), column, rules, path).select(column, "matched", "outcome")


def join_rated(rows: DataFrame, rated: DataFrame, column: str) -> DataFrame:
    """rows with matched and outcome of their text.

    A text may hold a third of all rows. With its hash as a second key the distinct texts need an exchange of their own, so
    that adaptive execution may split the hot text's rows; where they are few, it broadcasts them instead.
    """
    keyed = lambda frame: frame.withColumn("__hash", F.xxhash64(column))
    return keyed(rows).join(keyed(rated), [column, "__hash"], "left").drop("__hash")


def match(rows: DataFrame, column: str, rules: Rules) -> DataFrame:
    """rows with matched and outcome (null text: neither)."""
    joined = join_rated(rows, match_distinct(rows, column, rules), column)
    return joined.select(*rows.columns, "matched", "outcome")
