"""Text normalization and similarity as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that separate words besides white space (fixed values).
PUNCTUATION = r"""[-_.,;:!?()\[\]{}'"/\\]"""
#: Unicode white space; plain \s is ASCII only in Java.
SPACE = r"(?U)\s+"


def words(text: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def string_map(values: Mapping[str, str]) -> Column:
    """A literal map; an empty one keeps its type."""
    if not values:
        return F.from_json(F.lit("{}"), "map<string,string>")
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def normalize(text: Column, typos: Mapping[str, str]) -> Column:
    """Lower-cased words without punctuation, each corrected as a whole word, joined without separator."""
    cleaned = words(F.regexp_replace(F.lower(text), PUNCTUATION, " "))
    if not typos:
        return F.array_join(cleaned, "")
    fixes = string_map(typos)
    return F.array_join(F.transform(cleaned, lambda w: F.coalesce(F.try_element_at(fixes, w), w)), "")


def squeeze(text: Column) -> Column:
    """Lower-cased text without white space."""
    return F.regexp_replace(F.lower(text), SPACE, "")


#: Where a camel-case text is cut, in this order (fixed values).
CAMEL_CUTS = ("([a-z0-9])([A-Z])", "([A-Z]+)([A-Z][a-z])")


def camel_tokens(text: Column) -> Column:
    """Words of a camel-case text (ASCII letters): a capital begins a word, the last of several with what follows it."""
    for cut in CAMEL_CUTS:
        text = F.regexp_replace(text, cut, "$1 $2")
    return words(text)


def camel_concat(text: Column, typos: Mapping[str, str]) -> Column:
    """The normalized form of a camel-case text's words written together; null for a text of one word or none."""
    tokens = camel_tokens(text)
    return F.when(F.size(tokens) > 1, normalize(F.array_join(tokens, ""), typos))


def similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length, in code points and doubles; two empty texts are equal."""
    longer = F.greatest(F.length(a), F.length(b)).cast("double")
    return F.when(longer == 0, 1.0).otherwise(F.lit(1.0) - F.levenshtein(a, b) / longer)
