"""JSON Schemas compiled to SQL expressions over one parsed VARIANT.

A schema node becomes a test of a VARIANT, and a list of messages that is evaluated only where the test fails. A value is
looked at once for each node: what several of the node's keywords need of it (its members, elements, JSON type) is bound
to the fields of a struct. The compiler writes SQL text, as one text of thousands of calls is parsed in a moment, while
as many Column objects, each made through the bridge to the JVM, take seconds.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import count
from typing import Any

#: JSON types by the type that a VARIANT of them shows; numbers show many.
_SCALARS = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
_NONE = "cast(array() AS array<string>)"
_fresh = count()


class Recursive(Exception):
    """The schema refers to itself, so it has no finite expression."""


def text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def texts(values) -> str:
    return f"array({', '.join(map(text, values))})" if values else _NONE


def let(value: str, body: Callable[[str], str]) -> str:
    """body(value), with value computed once for each row."""
    name = f"v{next(_fresh)}"
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def over(function: str, items: str, body: Callable[..., str], indexed: bool = False) -> str:
    """A higher-order function over an array."""
    name = f"v{next(_fresh)}"
    return f"{function}({items}, ({name}, {name}i) -> {body(name, f'{name}i')})" if indexed else f"{function}({items}, {name} -> {body(name)})"


def members(value: str) -> str:
    """An object's members as map<string,variant>; null for anything else."""
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def elements(value: str) -> str:
    """An array's elements; null for anything else."""
    return f"try_variant_get({value}, '$', 'array<variant>')"


def kind(value: str) -> str:
    return f"schema_of_variant({value})"


def string(value: str) -> str:
    """The text of a string; null for anything else."""
    return f"CASE WHEN {kind(value)} = 'STRING' THEN try_variant_get({value}, '$', 'string') END"


def sure(test: str) -> str:
    return f"coalesce({test}, false)"


def _all(tests: list[str]) -> str:
    return " AND ".join(f"({t})" for t in tests) or "true"


def _any(tests: list[str]) -> str:
    return " OR ".join(f"({t})" for t in tests) or "false"


class _View:
    """What a node's keywords need of a value: bound fields of a struct, or else derived on the spot."""

    def __init__(self, value: str, bound: str = "", names: tuple[str, ...] = ()):
        self.value = value
        self.members = f"{bound}.m" if "m" in names else members(value)
        self.elements = f"{bound}.a" if "a" in names else elements(value)
        self.kind = f"{bound}.k" if "k" in names else kind(value)
        self.text = f"CASE WHEN {self.kind} = 'STRING' THEN try_variant_get({value}, '$', 'string') END"
        self.number = f"CASE WHEN {self.is_('number')} THEN try_variant_get({value}, '$', 'double') END"

    def is_(self, name: str) -> str:
        if name == "object":
            return f"{self.members} IS NOT NULL"
        if name == "array":
            return f"{self.elements} IS NOT NULL"
        if name in _SCALARS:
            return f"{self.kind} = '{_SCALARS[name]}'"
        number = f"{self.kind} NOT IN ('STRING', 'BOOLEAN', 'VOID') AND NOT startswith({self.kind}, 'OBJECT') AND NOT startswith({self.kind}, 'ARRAY')"
        if name == "integer":
            return f"CASE WHEN {number} THEN try_variant_get({self.value}, '$', 'double') = floor(try_variant_get({self.value}, '$', 'double')) ELSE false END"
        return number

    def equals(self, constant: Any) -> str:
        if constant is None:
            return self.is_("null")
        if isinstance(constant, bool):
            return f"CASE WHEN {self.is_('boolean')} THEN try_variant_get({self.value}, '$', 'boolean') = {str(constant).lower()} ELSE false END"
        if isinstance(constant, (int, float)):
            return sure(f"{self.number} = cast({text(repr(float(constant)))} AS double)")
        return f"to_json({self.value}) = to_json(parse_json({text(json.dumps(constant))}))"


class Compiled:
    """Expressions of one schema node and what is below it."""

    def __init__(self, node: Any, target: Callable[[str], Any], stack: tuple[str, ...] = ()):
        self.always: bool | None = node if isinstance(node, bool) else None
        self.ref: Compiled | None = None
        if isinstance(node, bool):
            return
        if "$ref" in node:
            if node["$ref"] in stack:
                raise Recursive(node["$ref"])
            self.ref = Compiled(target(node["$ref"]), target, (*stack, node["$ref"]))
            return
        sub = lambda x: Compiled(x, target, stack)
        self.node = node
        self.types = [node["type"]] if isinstance(node.get("type"), str) else node.get("type")
        self.properties = {k: sub(v) for k, v in node.get("properties", {}).items()}
        self.others = sub(node["additionalProperties"]) if "additionalProperties" in node else None
        self.items = sub(node["items"]) if "items" in node else None
        self.lists = {k: [sub(x) for x in node[k]] for k in ("allOf", "anyOf", "oneOf") if k in node}
        self.nested = {k: sub(node[k]) for k in ("not", "if", "then", "else") if k in node}
        self.allowed = node["enum"] if "enum" in node else [node["const"]] if "const" in node else None

    # -- what the keywords say

    def _needs(self) -> tuple[str, ...]:
        """Parts of the value that more than one keyword reads."""
        n, types = self.node, self.types or ()
        objects = ("object" in types) + len(n.get("required", [])) + len(self.properties) + 2 * (self.others is not None)
        arrays = ("array" in types) + (self.items is not None) + 2 * ("minItems" in n or "maxItems" in n)
        scalars = sum(3 if t in ("number", "integer") else t in _SCALARS for t in types) + len(self.allowed or ()) + 3 * sum(k in n for k in ("minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"))
        return tuple(name for name, uses in (("m", objects), ("a", arrays), ("k", scalars)) if uses > 1)

    def _with_view(self, value: str, body: Callable[[_View], str]) -> str:
        names, make = self._needs(), {"m": members, "a": elements, "k": kind}
        if not names:
            return body(_View(value))
        parts = ", ".join(f"'{n}', {make[n](value)}" for n in names)
        return let(f"named_struct('v', {value}, {parts})", lambda s: body(_View(f"{s}.v", s, names)))

    def _own(self, view: _View) -> dict[str, list[tuple[str, str]]]:
        """Tests of the value itself, with what each failure is called, by group of keywords."""
        n, head, tail = self.node, [], []
        if self.types is not None:
            head.append((f"not of type {n['type']}", sure(_any([view.is_(t) for t in self.types]))))
        if self.allowed is not None:
            strings = [x for x in self.allowed if isinstance(x, str)]
            rest = [view.equals(x) for x in self.allowed if not isinstance(x, str)]
            head.append(("not an allowed value", _any([sure(f"{view.text} IN ({', '.join(map(text, strings))})")] * bool(strings) + rest)))
        head += [(f"missing {key}", f"{view.members} IS NULL OR {self._item(view, text(key))} IS NOT NULL") for key in n.get("required", [])]
        size = []
        if "minItems" in n or "maxItems" in n:
            size.append(("wrong number of items", f"{view.elements} IS NULL OR size({view.elements}) BETWEEN {n.get('minItems', 0)} AND {n.get('maxItems', (1 << 31) - 1)}"))
        number = lambda x: f"cast({text(repr(float(x)))} AS double)"
        rules = (
            ("minLength", "too short", lambda x: f"length({view.text}) >= {x}"),
            ("maxLength", "too long", lambda x: f"length({view.text}) <= {x}"),
            ("pattern", "doesn't match the pattern", lambda x: f"{view.text} RLIKE {text(x)}"),
            ("minimum", "too small", lambda x: f"{view.number} >= {number(x)}"),
            ("exclusiveMinimum", "too small", lambda x: f"{view.number} > {number(x)}"),
            ("maximum", "too large", lambda x: f"{view.number} <= {number(x)}"),
            ("exclusiveMaximum", "too large", lambda x: f"{view.number} < {number(x)}"),
        )
        tail = [(says, f"coalesce({test(n[k])}, true)") for k, says, test in rules if k in n]
        return {"head": head, "size": size, "tail": tail}

    def _unknown(self, view: _View) -> str:
        """Keys that no property names."""
        return f"array_except(map_keys({view.members}), {texts(list(self.properties))})"

    def _combined(self, value: str) -> list[tuple[str, str]]:
        out = []
        if "anyOf" in self.lists:
            out.append(("matches none of anyOf", _any([c.test(value) for c in self.lists["anyOf"]])))
        if "oneOf" in self.lists:
            out.append(("doesn't match exactly one of oneOf", " + ".join(f"cast({c.test(value)} AS int)" for c in self.lists["oneOf"]) + " = 1"))
        if "not" in self.nested:
            out.append(("matches not", f"NOT ({self.nested['not'].test(value)})"))
        return out

    def _branches(self, value: str, make: Callable[[Compiled], str], otherwise: str) -> list[str]:
        if "if" not in self.nested or not {"then", "else"} & set(self.nested):
            return []
        branch = lambda name: make(self.nested[name]) if name in self.nested else otherwise
        return [f"CASE WHEN {self.nested['if'].test(value)} THEN {branch('then')} ELSE {branch('else')} END"]

    @staticmethod
    def _item(view: _View, key: str) -> str:
        return f"try_element_at({view.members}, {key})"

    # -- the expressions

    def test(self, value: str) -> str:
        """Whether a VARIANT (never a null of SQL) is valid."""
        if self.always is not None:
            return str(self.always).lower()
        if self.ref:
            return self.ref.test(value)

        def body(view: _View) -> str:
            tests = [ok for group in self._own(view).values() for _, ok in group]
            for key, below in self.properties.items():
                if below.always is not True:
                    tests.append(let(self._item(view, text(key)), lambda x, below=below: f"{x} IS NULL OR {below.test(x)}"))
            if self.others is not None and self.others.always is not True:
                odd = self._unknown(view)
                fine = f"size({odd}) = 0" if self.others.always is False else over("forall", odd, lambda k: self.others.test(self._item(view, k)))
                tests.append(f"{view.members} IS NULL OR {fine}")
            if self.items is not None:
                tests.append(f"coalesce({over('forall', view.elements, self.items.test)}, true)")
            tests += [c.test(view.value) for c in self.lists.get("allOf", [])] + [ok for _, ok in self._combined(view.value)]
            return _all(tests + self._branches(view.value, lambda c: c.test(view.value), "true"))

        return f"({self._with_view(value, body)})"

    def messages(self, value: str, path: str) -> str:
        """What is wrong with an invalid VARIANT, as array<string>; path: SQL of its path, '' for the root."""
        where = f"CASE WHEN {path} = '' THEN '/' ELSE {path} END"
        if self.always is not None:
            return _NONE if self.always else f"array(concat({where}, ': not allowed'))"
        if self.ref:
            return self.ref.messages(value, path)

        def told(tests: list[tuple[str, str]]) -> list[str]:
            return [f"CASE WHEN {ok} THEN {_NONE} ELSE array(concat({where}, {text(': ' + says)})) END" for says, ok in tests]

        def body(view: _View) -> str:
            own = self._own(view)
            out = told(own["head"])
            for key, below in self.properties.items():
                if below.always is not True:
                    out.append(let(self._item(view, text(key)), lambda x, key=key, below=below: f"CASE WHEN {x} IS NULL THEN {_NONE} ELSE {below.errors(x, f'concat({path}, {text("/" + key)})')} END"))
            if self.others is not None and self.others.always is not True:
                each = over("transform", self._unknown(view), lambda k: self.others.errors(self._item(view, k), f"concat({path}, '/', {k})"))
                out.append(f"coalesce(flatten({each}), {_NONE})")
            out += told(own["size"])
            if self.items is not None:
                each = over("transform", view.elements, lambda x, i: self.items.errors(x, f"concat({path}, '/', {i})"), indexed=True)
                out.append(f"coalesce(flatten({each}), {_NONE})")
            out += told(own["tail"]) + [c.errors(view.value, path) for c in self.lists.get("allOf", [])] + told(self._combined(view.value))
            out += self._branches(view.value, lambda c: c.errors(view.value, path), _NONE)
            return f"concat({', '.join(out)})" if out else _NONE

        return self._with_view(value, body)

    def errors(self, value: str, path: str = "''") -> str:
        """messages() of an invalid value, nothing of a valid one: only what fails its test is looked at again."""
        if self.always is not None:
            return self.messages(value, path)
        return f"CASE WHEN {self.test(value)} THEN {_NONE} ELSE {self.messages(value, path)} END"
