"""Provenance of enrichment records: configuration, validation and the literal columns made of it."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import ConfigError
from .vocabularies import CONTRIBUTOR_TYPES, NAME_TYPES, RELATED_IDENTIFIER_TYPES, RELATION_TYPES, RESOURCE_TYPES_GENERAL


@dataclass(frozen=True)
class NameIdentifier:
    nameIdentifier: str
    nameIdentifierScheme: str
    schemeUri: str | None = None


@dataclass(frozen=True)
class Affiliation:
    name: str
    affiliationIdentifier: str | None = None
    affiliationIdentifierScheme: str | None = None
    schemeUri: str | None = None


@dataclass(frozen=True)
class Contributor:
    """Fields stand in the order in which they are written."""

    name: str
    nameType: str | None = None
    lang: str | None = None
    contributorType: str = ""
    givenName: str | None = None
    familyName: str | None = None
    nameIdentifiers: tuple[NameIdentifier, ...] | None = None
    affiliation: tuple[Affiliation, ...] | None = None


@dataclass(frozen=True)
class Resource:
    relatedIdentifier: str
    relatedIdentifierType: str
    relationType: str
    relatedMetadataScheme: str | None = None
    schemeUri: str | None = None
    resourceTypeGeneral: str | None = None


@dataclass(frozen=True)
class Provenance:
    contributors: tuple[Contributor, ...]
    resources: tuple[Resource, ...]


_REQUIRED = {Contributor: {"name", "contributorType"}, NameIdentifier: {"nameIdentifier", "nameIdentifierScheme"}, Affiliation: {"name"}, Resource: {"relatedIdentifier", "relatedIdentifierType", "relationType"}}
_NESTED = {"nameIdentifiers": NameIdentifier, "affiliation": Affiliation}
CONTRIBUTOR_DDL = (
    "array<struct<name: string, nameType: string, lang: string, contributorType: string, givenName: string, familyName: string,"
    " nameIdentifiers: array<struct<nameIdentifier: string, nameIdentifierScheme: string, schemeUri: string>>,"
    " affiliation: array<struct<name: string, affiliationIdentifier: string, affiliationIdentifierScheme: string, schemeUri: string>>>>"
)
RESOURCE_DDL = "array<struct<relatedIdentifier: string, relatedIdentifierType: string, relationType: string, relatedMetadataScheme: string, schemeUri: string, resourceTypeGeneral: string>>"


def _build(kind: type, data: Any, where: str) -> Any:
    """An instance of a dataclass; unknown, missing and wrongly typed keys are errors."""
    if not isinstance(data, dict):
        raise ConfigError(f"{where}: expected a mapping")
    known = {f.name: f for f in fields(kind)}
    for key in data:
        if key not in known:
            raise ConfigError(f"{where}: unknown field `{key}`, expected one of {', '.join(known)}")
    for key in known:
        if key in _REQUIRED[kind] and data.get(key) is None:
            raise ConfigError(f"{where}: missing field `{key}`")
    made = {}
    for key, value in data.items():
        if key in _NESTED and value is not None:
            made[key] = tuple(_build(_NESTED[key], v, f"{where}.{key}[{i}]") for i, v in enumerate(_list(value, f"{where}.{key}")))
        elif value is not None and not isinstance(value, str):
            raise ConfigError(f"{where}.{key}: expected a string, not {value!r}")
        else:
            made[key] = value
    return kind(**made)


def _list(value: Any, where: str) -> list:
    if not isinstance(value, list):
        raise ConfigError(f"{where}: expected a list")
    return value


def provenance_from(data: Any) -> Provenance:
    if not isinstance(data, dict):
        raise ConfigError("provenance must be a mapping")
    for key in data:
        if key not in ("contributors", "resources"):
            raise ConfigError(f"unknown field `{key}`, expected contributors or resources")
    parts = []
    for key, kind in (("contributors", Contributor), ("resources", Resource)):
        if key not in data:
            raise ConfigError(f"missing field `{key}`")
        parts.append(tuple(_build(kind, v, f"{key}[{i}]") for i, v in enumerate(_list(data[key], key))))
    return Provenance(*parts)


def problems(p: Provenance, organization: str | None = None) -> list[str]:
    """Everything that is wrong, in a fixed order. `organization` is the producer's required name (None: any)."""
    out = []
    if not p.contributors:
        out.append("contributors must not be empty")
    if not p.resources:
        out.append("resources must not be empty")

    def unknown(entry: str, name: str, value: str | None, valid: tuple[str, ...]) -> None:
        if value is not None and value not in valid:
            out.append(f"{entry}: unknown {name} {json.dumps(value, ensure_ascii=False)}\n      (valid: {', '.join(sorted(valid))})")

    for i, c in enumerate(p.contributors):
        unknown(f"contributors[{i}]", "contributorType", c.contributorType, CONTRIBUTOR_TYPES)
        unknown(f"contributors[{i}]", "nameType", c.nameType, NAME_TYPES)
    for i, r in enumerate(p.resources):
        unknown(f"resources[{i}]", "relationType", r.relationType, RELATION_TYPES)
        unknown(f"resources[{i}]", "relatedIdentifierType", r.relatedIdentifierType, RELATED_IDENTIFIER_TYPES)
        unknown(f"resources[{i}]", "resourceTypeGeneral", r.resourceTypeGeneral, RESOURCE_TYPES_GENERAL)
    if not any((organization is None or c.name == organization) and c.nameType == "Organizational" and c.contributorType == "Producer" for c in p.contributors):
        out.append(f"missing required contributor: {organization or 'any name'} / Organizational / Producer")
    for relation, general in (("IsDocumentedBy", "Project"), ("IsDerivedFrom", "Dataset")):
        if not any(r.relationType == relation and r.resourceTypeGeneral == general for r in p.resources):
            out.append(f"missing required resource: {relation} / {general}")
    return out


def text_problems(text: str, organization: str | None = None) -> list[str]:
    """Everything that is wrong with a provenance file's text (YAML, or JSON as a part of it); a refused file has one problem."""
    try:
        return problems(provenance_from(yaml.safe_load(text)), organization)
    except (yaml.YAMLError, ConfigError) as error:
        return [f"refused: {error}"]


def file_problems(files: DataFrame, key: str) -> DataFrame:
    """(key, pos, problem) of provenance files given as rows of key, value (text) and organization: one row a problem, in order."""
    kind = files.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i, p) for k, text, organization in batch.itertuples(index=False) for i, p in enumerate(text_problems(text, organization))]
            yield pd.DataFrame(rows, columns=[key, "pos", "problem"])

    return files.select(key, "value", "organization").mapInPandas(run, f"`{key}` {kind}, pos int, problem string")


def load_provenance(path: str | Path, organization: str | None = None) -> Provenance:
    try:
        p = provenance_from(yaml.safe_load(Path(path).read_text(encoding="utf-8")))
    except (OSError, yaml.YAMLError, ConfigError) as error:
        raise ConfigError(f"provenance {path}: {error}") from error
    found = problems(p, organization)
    if found:
        raise ConfigError(f"provenance {path} is invalid:\n  - " + "\n  - ".join(found))
    return p


def as_json(value: Any) -> Any:
    """Plain data in writing order, without absent fields."""
    if isinstance(value, tuple):
        return [as_json(v) for v in value]
    if hasattr(value, "__dataclass_fields__"):
        return {f.name: as_json(v) for f in fields(value) if (v := getattr(value, f.name)) is not None}
    return value


def template(p: Provenance) -> tuple[Column, Column]:
    """(contributors, resources) as constant columns; absent fields stay out of the JSON written from them."""
    return F.from_json(F.lit(json.dumps(as_json(p.contributors))), CONTRIBUTOR_DDL), F.from_json(F.lit(json.dumps(as_json(p.resources))), RESOURCE_DDL)


def record_column(p: Provenance, field: str) -> Column:
    """The enrichment record of columns doi, action, original, enriched as JSON text, keys in fixed order."""
    contributors, resources = template(p)
    head = F.to_json(F.struct("doi", contributors.alias("contributors"), resources.alias("resources"), "action", F.lit(field).alias("field")))
    part = lambda key, value: F.coalesce(F.concat(F.lit(f',"{key}":'), value), F.lit(""))
    return F.concat(F.regexp_replace(head, r"\}$", ""), part("originalValue", F.col("original")), part("enrichedValue", F.col("enriched")), F.lit("}"))


