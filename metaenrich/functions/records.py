"""Strict JSON parsing and typed access to VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict(line: Column, exact: bool = False) -> Column:
    """struct(ok, record): whether the line is exactly one JSON value (null for a null line), and that value as VARIANT.

    The parser accepts trailing text after a value. The line is parsed once, as `[v]`, and its tokens are read once more
    as `{"w":v}`, without building a value: both are accepted only if v is exactly one value, as what follows a complete
    value would have to be legal inside a list and inside an object. With `exact`, what is_exact() refuses isn't ok
    either.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    named = F.json_object_keys(F.concat(F.lit('{"w":'), line, F.lit("}")))
    ok = F.when(line.isNotNull(), F.is_valid_utf8(line) & listed.isNotNull() & named.isNotNull() & (is_exact(line) if exact else F.lit(True)))
    return F.struct(ok.alias("ok"), F.when(ok, F.try_variant_get(listed, "$[0]", "variant")).alias("record"))


#: A high surrogate's escape without a low one's after it, or a low one's without a high one's before; neither behind a backslash of its own.
_LONE = (
    r"(?<!\\)(?:\\\\)*\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F][0-9a-fA-F]{2})",
    r"(?<!\\u[dD][89abAB][0-9a-fA-F]{2})(?<!\\)(?:\\\\)*\\u[dD][c-fC-F][0-9a-fA-F]{2}",
)
_STRING = r'"[^"\\]*(?:\\.[^"\\]*)*"'
_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
#: What a number beyond the doubles must have: an exponent of two digits or more, or very many digits.
_VAST = r"[0-9][eE]\+?[0-9]{2}|[0-9]{309}"


def is_exact(line: Column) -> Column:
    """Whether a JSON text holds no lone surrogate and no number beyond the doubles: strict parsers refuse both.

    The parser takes the one for a question mark, the other for infinity. Both are looked for only in lines that have an
    escaped surrogate, or a vast exponent or digits.
    """
    lone = F.when(line.contains("\\ud") | line.contains("\\uD"), line.rlike(_LONE[0]) | line.rlike(_LONE[1])).otherwise(F.lit(False))
    numbers = F.regexp_extract_all(F.regexp_replace(line, _STRING, '""'), F.lit(_NUMBER), F.lit(0))
    vast = F.when(line.rlike(_VAST), F.exists(numbers, lambda n: F.abs(n.cast("double")) == float("inf"))).otherwise(F.lit(False))
    return ~lone & ~vast


def is_blank(line: Column) -> Column:
    return line.rlike(r"(?U)^\s*$")


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def text_at(value: Column, path: str) -> Column:
    """The string at a path; null for anything that isn't a string (numbers are not turned into text)."""
    found = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))
