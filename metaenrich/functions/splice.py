"""Editing JSON texts without touching the rest: new values are written between the tokens of the source text.

Untouched parts keep the order of their keys, the spelling of their numbers (1.0, -0.0, 1e400) and their escapes; only white
space between tokens goes. Where an edited object repeats a key, the last value counts, at the first one's place. The
texts must be JSON (the parser has seen them before); anything but an object has no members, anything but a list no
elements.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{}\[\],:]|[^\s{}\[\],:"]+', re.DOTALL)
_DECODE = json.JSONDecoder(strict=False).decode


def _parts(text: str, opening: str) -> Iterator[str]:
    """The texts between the commas of a list or object, without white space between tokens; a colon stays where it is."""
    tokens = iter(_TOKEN.findall(text))
    if next(tokens, None) != opening:
        return
    depth, held = 1, []
    for token in tokens:
        if token == ",":
            if depth == 1:
                if held:
                    yield "".join(held)
                held = []
                continue
        elif token == "{" or token == "[":
            depth += 1
        elif token == "}" or token == "]":
            depth -= 1
            if not depth:
                if held:
                    yield "".join(held)
                return
        held.append(token)


def elements(text: str) -> list[str]:
    return list(_parts(text, "["))


def members(text: str) -> dict[str, tuple[str, str]]:
    """Key to (its text, its value's text), in order."""
    out: dict[str, tuple[str, str]] = {}
    for part in _parts(text, "{"):
        raw = _TOKEN.match(part)[0]
        key = _DECODE(raw) if "\\" in raw else raw[1:-1]
        out[key] = (out[key][0] if key in out else raw, part[len(raw) + 1 :])
    return out


def value_at(text: str, path: tuple[str, ...]) -> str | None:
    """The text of the value at a path of keys."""
    for key in path:
        found = members(text).get(key)
        if found is None:
            return None
        text = found[1]
    return text


def _written(found: dict[str, tuple[str, str]]) -> str:
    return ",".join(f"{key}:{value}" for key, value in found.values())


def _set(found: dict[str, tuple[str, str]], key: str, value: str) -> None:
    found[key] = (found[key][0] if key in found else json.dumps(key), value)


def cut(text: str, key: str, constants: dict[str, str] | None = None) -> tuple[str, str]:
    """An object's text before and behind the value of a key, which is in place or else comes last; constants are set after it."""
    return _cut(members(text), key, constants)


def _cut(found: dict[str, tuple[str, str]], key: str, constants: dict[str, str] | None = None) -> tuple[str, str]:
    _set(found, key, "")
    for name, value in (constants or {}).items():
        _set(found, name, value)
    items, at = list(found.items()), list(found).index(key)
    before, after = dict(items[:at]), dict(items[at + 1 :])
    own = found[key][0] + ":"
    return "{" + _written(before) + "," * bool(before) + own, "," * bool(after) + _written(after) + "}"


# -- as columns


def quoted(value: Column) -> Column:
    """A string as JSON text."""
    return F.to_json(value.cast("variant"))


def raw_at(text: Column, *path: str) -> Column:
    """The text of the value at a path; null where there is none."""

    @pandas_udf("string")
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else value_at(t, path))

    return read(text)


def raw_elements(text: Column, *path: str) -> Column:
    """The texts of the elements of the list at a path; an empty array where there is none."""

    @pandas_udf("array<string>")
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else elements(value_at(t, path) or ""))

    return read(text)


def raw_cut(text: Column, key: str, **constants: str) -> Column:
    """struct(whole, before, behind): an object's text, and cut around the value of a key, with constant strings set."""
    fixed = {k: json.dumps(v) for k, v in constants.items()}

    @pandas_udf("whole string, before string, behind string")
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = {} if t is None else members(t)
            rows.append((None,) * 3 if t is None else ("{" + _written(found) + "}", *_cut(found, key, fixed)))
        return pd.DataFrame(rows, columns=["whole", "before", "behind"])

    return read(text)


def raw_list_cut(text: Column, key: str, wrap: str, inner: str, **constants: str) -> Column:
    """struct(whole, before, items, behind): an object's text around the elements of its list, and each element as it is and cut.

    items: (raw, before, behind) of each element of the list at key, cut around the value of inner; an element that is no
    object is wrapped in one first, as its member `wrap`.
    """
    fixed = {k: json.dumps(v) for k, v in constants.items()}

    def item(raw: str) -> dict:
        before, behind = cut(raw if raw.startswith("{") else f"{{{json.dumps(wrap)}:{raw}}}", inner, fixed)
        return {"raw": raw, "before": before, "behind": behind}

    @pandas_udf("whole string, before string, items array<struct<raw: string, before: string, behind: string>>, behind string")
    def read(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = members(t)
            whole, listed = "{" + _written(found) + "}", elements(found.get(key, ("", ""))[1])
            before, behind = _cut(found, key)
            rows.append((whole, before + "[", [item(e) for e in listed], "]" + behind))
        return pd.DataFrame(rows, columns=["whole", "before", "items", "behind"])

    return read(text)
