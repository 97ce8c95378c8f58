"""Compiled schemas against the plain validator."""

import json
import random

import pytest
from pyspark.sql import functions as F

from metaenrich.operators.rules import ConfigError
from metaenrich.operators.schema import JsonSchema, builtin_schema, record_errors, validate_json
from metaenrich.plans.catalogue import NESTED, PROVENANCE_CASES, RESOURCES
from metaenrich.sources.corpus import configure

SCHEMAS = [
    True,
    False,
    {},
    {"type": "object", "required": ["a", "b"], "properties": {"a": {"type": "string", "minLength": 2, "maxLength": 3}, "b": {"type": ["integer", "null"]}}},
    {"type": "object", "properties": {"a": {"type": "number", "minimum": 1, "exclusiveMaximum": 3}}, "additionalProperties": False},
    {"properties": {"a": {"const": 1}, "b": {"enum": [True, None, "x", 2.5, [1, {"k": "v"}], {"z": 1, "a": [None]}]}}, "additionalProperties": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"type": "integer"}}},
    {"items": {"oneOf": [{"type": "number"}, {"type": "integer"}, {"type": "string", "pattern": "^[a-c]+$"}]}},
    {"anyOf": [{"type": "array", "items": {"$ref": "#/definitions/node"}}, {"$ref": "#/definitions/node"}], "definitions": {"node": {"type": "object", "required": ["a"], "additionalProperties": {"not": {"type": "string"}}}}},
    {"if": {"properties": {"a": {"enum": ["x", "ab"]}}, "required": ["a"]}, "then": {"required": ["b"]}, "else": {"allOf": [{"type": ["object", "array", "boolean"]}, {"maxItems": 1}]}},
    {"type": "string", "exclusiveMinimum": 0, "maximum": 2},
    builtin_schema(),
]


def value(rng, depth=0):
    leaf = [None, True, False, 0, 1, 2, 2.5, 3, -1, 1.0, "", "x", "ab", "abc", "abcd", "é", "é\U0001f600"]
    if depth > 2 or rng.random() < 0.4:
        return rng.choice(leaf)
    if rng.random() < 0.3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {k: value(rng, depth + 1) for k in rng.sample(["a", "b", "c", "doi", "k", "z"], rng.randrange(4))}


def records(rng):
    """Records of which some are valid."""
    good = rng.random() < 0.4
    contributors, resources = [json.loads(c) for c, ok in NESTED if ok or not good], [json.loads(r) for r in RESOURCES[: 2 if good else None]]
    some = lambda of: [rng.choice(of) for _ in range(rng.randrange(good, 3))]
    pick = lambda *of: of[0] if good else rng.choice(of)
    record = {"doi": pick("x", 1, None), "contributors": some(contributors), "resources": some(resources), "action": pick("update", "insert", "no", 3), "field": pick("types", "nope"), "originalValue": value(rng), "enrichedValue": value(rng), "odd": 1}
    for key in ["odd"] if good else rng.sample(list(record), rng.randrange(4)):
        del record[key]
    return record


@pytest.mark.parametrize("schema", SCHEMAS, ids=range(len(SCHEMAS)))
def test_compiled_schemas_equal_the_plain_validator(spark, schema):
    configure(spark)
    rng = random.Random(11)
    values = [value(rng) for _ in range(150)] + [records(rng) for _ in range(60)] + [[1, {"k": "v"}], {"b": [1, {"k": "v"}]}, {"b": {"a": [None], "z": 1}}, {"b": {"a": [None], "z": 2}}, {"a": True}, {"a": 1.0}]
    frame = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, value string").coalesce(1)
    plain = JsonSchema(schema)
    found = {r.i: r.errors for r in validate_json(frame, plain).collect()}
    assert {i: sorted(e) for i, e in found.items()} == {i: sorted(plain.errors(v)) for i, v in enumerate(values)}


def test_texts_that_are_no_json(spark):
    configure(spark)
    frame = spark.createDataFrame([("{",), ('{"a":1} x',), (None,), ("",), ("1",)], "value string")
    assert [r.errors for r in validate_json(frame, JsonSchema({})).collect()] == [["/: no JSON"]] * 4 + [[]]


def test_a_schema_that_refers_to_itself(spark):
    tree = JsonSchema({"$ref": "#/definitions/t", "definitions": {"t": {"type": "object", "properties": {"c": {"type": "array", "items": {"$ref": "#/definitions/t"}}}, "additionalProperties": False}}})
    frame = spark.createDataFrame([('{"c":[{"c":[{}]},{}]}',), ('{"c":[{"c":[{"x":1}]},{}]}',), ("nope",)], "value string")
    assert [r.errors for r in validate_json(frame, tree).collect()] == [[], ["/c/0/c/0/x: not allowed"], ["/: no JSON"]]


def test_built_in_rules_agree_with_the_built_in_schema(spark):
    configure(spark)
    rng, plain = random.Random(12), JsonSchema(builtin_schema())
    values = [records(rng) for _ in range(400)] + [None, 7, [], "x", {}] + [d for _, d, _ in PROVENANCE_CASES]
    frame = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, value string").coalesce(1)
    found = {r.i: r.e for r in frame.select("i", record_errors("value").alias("e")).collect()}
    assert {i: not e for i, e in found.items()} == {i: not plain.errors(v) for i, v in enumerate(values)}
    assert found[400] == ["object", "additional", "doi", "contributors", "resources", "action", "field"] and 30 < sum(not e for e in found.values()) < 200


def test_schemas_with_unknown_keywords_are_refused():
    for bad in ({"propertyNames": {}}, {"properties": {"a": {"uniqueItems": True}}}, 3, {"$ref": "#/nowhere"}, {"$ref": "http://x"}):
        with pytest.raises(ConfigError):
            JsonSchema(bad)
