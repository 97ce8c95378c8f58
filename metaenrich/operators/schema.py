"""Validation of enrichment records: built-in rules and custom JSON Schemas, both compiled to column expressions."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import records as R
from .rules import ConfigError
from .schema_compiler import Compiled, Recursive, elements, let, members, over, string, sure, text, texts
from .vocabularies import ACTIONS, CONTRIBUTOR_TYPES, FIELDS, NAME_TYPES, RELATED_IDENTIFIER_TYPES, RELATION_TYPES, RESOURCE_TYPES_GENERAL

_TEXT, _TEXT_OR_NULL = {"type": "string"}, {"type": ["string", "null"]}


def _closed(required: list[str], **properties: dict) -> dict:
    return {"type": "object", "additionalProperties": False, "required": required, "properties": properties}


def _one_of(values: tuple[str, ...]) -> dict:
    return {"type": "string", "enum": list(values)}


def builtin_schema() -> dict:
    """The output schema as JSON Schema (draft 7), made of the vocabularies."""
    identifiers = {"type": "array", "items": _closed(["nameIdentifier", "nameIdentifierScheme"], nameIdentifier=_TEXT, nameIdentifierScheme=_TEXT, schemeUri=_TEXT_OR_NULL)}
    affiliations = {"type": "array", "items": _closed(["name"], name=_TEXT, affiliationIdentifier=_TEXT_OR_NULL, affiliationIdentifierScheme=_TEXT_OR_NULL, schemeUri=_TEXT_OR_NULL)}
    contributor = _closed(
        ["name", "contributorType"],
        name=_TEXT,
        nameType={"anyOf": [_one_of(NAME_TYPES), {"type": "null"}]},
        givenName=_TEXT_OR_NULL,
        familyName=_TEXT_OR_NULL,
        lang=_TEXT_OR_NULL,
        affiliation=affiliations,
        nameIdentifiers=identifiers,
        contributorType=_one_of(CONTRIBUTOR_TYPES),
    )
    resource = _closed(
        ["relatedIdentifier", "relationType", "relatedIdentifierType"],
        relatedIdentifier=_TEXT,
        relationType=_one_of(RELATION_TYPES),
        relatedIdentifierType=_one_of(RELATED_IDENTIFIER_TYPES),
        relatedMetadataScheme=_TEXT,
        schemeUri=_TEXT,
        resourceTypeGeneral=_one_of(RESOURCE_TYPES_GENERAL),
    )
    value = {"oneOf": [{"type": t} for t in ("object", "string", "number", "array")]}
    needs = lambda actions, key: {"if": {"properties": {"action": {"enum": actions}}}, "then": {"required": [key]}}
    record = _closed(
        ["doi", "contributors", "resources", "action", "field"],
        doi=_TEXT,
        contributors={"type": "array", "minItems": 1, "items": contributor},
        resources={"type": "array", "minItems": 1, "items": resource},
        field=_one_of(FIELDS),
        action=_one_of(ACTIONS),
        originalValue=value,
        enrichedValue=value,
    )
    return record | {"allOf": [needs(["update", "updateChild", "deleteChild"], "originalValue"), needs(["update", "updateChild", "insert"], "enrichedValue")]}


def _record_rules(line: str) -> str:
    """SQL of the names of the built-in rules that a JSON text breaks; the text is parsed once, each member taken out once."""
    schema = builtin_schema()
    known = schema["properties"]
    compiled = lambda node: Compiled(node, lambda ref: None)

    def rules(top: str) -> str:
        at = lambda key: f"try_element_at({top}, '{key}')"
        is_value = lambda key: let(at(key), lambda x: f"{x} IS NULL OR {compiled(known[key]).test(x)}")
        whole = f"named_struct('contributors', {elements(at('contributors'))}, 'resources', {elements(at('resources'))}, 'action', {string(at('action'))})"

        def judged(own: str) -> str:
            filled = lambda key: sure(f"size({own}.{key}) > 0")
            shaped = lambda key: f"NOT {filled(key)} OR {over('forall', f'{own}.{key}', compiled(known[key]['items']).test)}"
            implied = lambda actions, key: f"NOT {sure(f"{own}.action IN ({', '.join(map(text, actions))})")} OR {at(key)} IS NOT NULL"
            tests = {
                "object": f"{top} IS NOT NULL",
                "additional": f"size(array_except(map_keys({top}), {texts(list(known))})) = 0",
                "doi": f"{string(at('doi'))} IS NOT NULL",
                "contributors": filled("contributors"),
                "contributor_shape": shaped("contributors"),
                "resources": filled("resources"),
                "resource_shape": shaped("resources"),
                "action": f"{own}.action IN ({', '.join(map(text, ACTIONS))})",
                "field": f"{string(at('field'))} IN ({', '.join(map(text, FIELDS))})",
                "original_type": is_value("originalValue"),
                "enriched_type": is_value("enrichedValue"),
                "original_required": implied(["update", "updateChild", "deleteChild"], "originalValue"),
                "enriched_required": implied(["update", "updateChild", "insert"], "enrichedValue"),
            }
            broken = ", ".join(f"CASE WHEN NOT {sure(ok)} THEN '{name}' END" for name, ok in tests.items())
            return over("filter", f"array({broken})", lambda e: f"{e} IS NOT NULL")

        return let(whole, judged)

    return let(members(f"try_parse_json({line})"), rules)


def record_errors(line: str) -> Column:
    """Names of the built-in rules that a record (JSON text of the named column) breaks, nested shapes included; empty for a valid one."""
    return F.expr(_record_rules(f"`{line}`"))


class JsonSchema:
    """Draft-7 subset: type, enum, const, required, properties, additionalProperties, items, minItems, maxItems,
    minLength, maxLength, pattern, bounds of numbers, oneOf, anyOf, allOf, not, if/then/else and local $ref. Any other
    keyword is refused. compiled() gives the schema as column expressions, errors() judges one value in Python: for schemas
    that refer to themselves, and for comparison."""

    NOTES = frozenset({"$schema", "$id", "$comment", "title", "description", "definitions", "$defs", "default", "examples", "format"})
    KNOWN = frozenset({"type", "enum", "const", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "oneOf", "anyOf", "allOf", "not", "if", "then", "else", "$ref"})

    def __init__(self, schema: dict):
        self.root = schema
        self._check(schema)

    def _check(self, node: Any) -> None:
        if isinstance(node, bool):
            return
        if not isinstance(node, dict):
            raise ConfigError(f"a schema must be an object, not {node!r}")
        for key, value in node.items():
            if key not in self.KNOWN and key not in self.NOTES:
                raise ConfigError(f"unsupported schema keyword {key!r}")
            if key in ("properties", "definitions", "$defs"):
                for sub in value.values():
                    self._check(sub)
            elif key in ("oneOf", "anyOf", "allOf"):
                for sub in value:
                    self._check(sub)
            elif key in ("items", "not", "if", "then", "else", "additionalProperties"):
                self._check(value)
            elif key == "$ref":
                self._target(value)

    def _target(self, ref: str) -> Any:
        if not ref.startswith("#"):
            raise ConfigError(f"only local references are supported: {ref!r}")
        node = self.root
        for step in filter(None, ref[1:].split("/")):
            try:
                node = node[step.replace("~1", "/").replace("~0", "~")]
            except (KeyError, TypeError) as error:
                raise ConfigError(f"no such definition: {ref!r}") from error
        return node

    def compiled(self) -> Compiled:
        """Raises Recursive for a schema that refers to itself."""
        return Compiled(self.root, self._target)

    @staticmethod
    def _equal(a: Any, b: Any) -> bool:
        """Equality of JSON values: 1 equals 1.0, true doesn't equal 1."""
        return a == b and isinstance(a, bool) == isinstance(b, bool)

    @staticmethod
    def _is(value: Any, kind: str) -> bool:
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return {
            "object": isinstance(value, dict),
            "array": isinstance(value, list),
            "string": isinstance(value, str),
            "boolean": isinstance(value, bool),
            "null": value is None,
            "number": number,
            "integer": number and float(value).is_integer(),
        }[kind]

    def errors(self, value: Any, schema: Any = None, path: str = "") -> list[str]:
        s = self.root if schema is None else schema
        if isinstance(s, bool):
            return [] if s else [f"{path or '/'}: not allowed"]
        where, out = path or "/", []
        valid = lambda sub: not self.errors(value, sub, path)
        if "$ref" in s:
            return self.errors(value, self._target(s["$ref"]), path)
        if "type" in s and not any(self._is(value, k) for k in ([s["type"]] if isinstance(s["type"], str) else s["type"])):
            out.append(f"{where}: not of type {s['type']}")
        if not any(self._equal(v, value) for v in s.get("enum", [s["const"]] if "const" in s else [value])):
            out.append(f"{where}: not an allowed value")
        if isinstance(value, dict):
            known = s.get("properties", {})
            out += [f"{where}: missing {k}" for k in s.get("required", []) if k not in value]
            for key, item in value.items():
                if key in known:
                    out += self.errors(item, known[key], f"{path}/{key}")
                elif "additionalProperties" in s:
                    out += self.errors(item, s["additionalProperties"], f"{path}/{key}")
        if isinstance(value, list):
            if len(value) < s.get("minItems", 0) or len(value) > s.get("maxItems", len(value)):
                out.append(f"{where}: wrong number of items")
            if "items" in s:
                for i, item in enumerate(value):
                    out += self.errors(item, s["items"], f"{path}/{i}")
        if isinstance(value, str):
            out += [f"{where}: too short"] * (len(value) < s.get("minLength", 0)) + [f"{where}: too long"] * (len(value) > s.get("maxLength", len(value)))
            if "pattern" in s and not re.search(s["pattern"], value):
                out.append(f"{where}: doesn't match the pattern")
        if self._is(value, "number"):
            low, high = s.get("minimum", value), s.get("maximum", value)
            out += [f"{where}: too small"] * ((value < low) + ("exclusiveMinimum" in s and value <= s["exclusiveMinimum"]))
            out += [f"{where}: too large"] * ((value > high) + ("exclusiveMaximum" in s and value >= s["exclusiveMaximum"]))
        for sub in s.get("allOf", []):
            out += self.errors(value, sub, path)
        if "anyOf" in s and not any(map(valid, s["anyOf"])):
            out.append(f"{where}: matches none of anyOf")
        if "oneOf" in s and sum(map(valid, s["oneOf"])) != 1:
            out.append(f"{where}: doesn't match exactly one of oneOf")
        if "not" in s and valid(s["not"]):
            out.append(f"{where}: matches not")
        if "if" in s:
            branch = "then" if valid(s["if"]) else "else"
            if branch in s:
                out += self.errors(value, s[branch], path)
        return out


def load_schema(path: str | Path) -> JsonSchema:
    try:
        return JsonSchema(json.loads(Path(path).read_text(encoding="utf-8")))
    except (OSError, ValueError) as error:
        raise ConfigError(f"schema {path}: {error}") from error


def validate_json(rows: DataFrame, schema: JsonSchema, column: str = "value", into: str = "errors") -> DataFrame:
    """rows with the schema errors of a JSON text column; texts that aren't one JSON value have one error.

    A schema that refers to itself is judged in Arrow batches, as it has no finite expression.
    """
    try:
        compiled = schema.compiled()
    except Recursive:
        return _validate_in_python(rows, schema, column, into)
    parsed = rows.withColumn(into, R.strict(F.col(column)))
    bad = "array('/: no JSON')"
    judged = let(f"`{into}`", lambda p: f"CASE WHEN {p}.ok THEN {compiled.errors(f'{p}.record')} ELSE {bad} END")
    return parsed.withColumn(into, F.expr(f"coalesce({judged}, {bad})"))


def _validate_in_python(rows: DataFrame, schema: JsonSchema, column: str, into: str) -> DataFrame:
    names = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for line in batch[column]:
                try:
                    found.append(schema.errors(json.loads(line)))
                except (ValueError, TypeError):
                    found.append(["/: no JSON"])
            yield batch[names].assign(**{into: found})

    return rows.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {into} array<string>")
