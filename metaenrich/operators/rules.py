"""Rules of the resource-type reclassification."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

from .vocabularies import RESOURCE_TYPES_GENERAL


class ConfigError(ValueError):
    """A configuration file that can't be used."""


@dataclass(frozen=True)
class Exclusion:
    normalized: tuple[str, ...]
    matches: tuple[str, ...]


@dataclass(frozen=True)
class Rules:
    threshold: float
    reference_values: tuple[str, ...]
    typo_corrections: dict[str, str] = field(default_factory=dict)
    redundancy_exclusions: tuple[Exclusion, ...] = ()
    target_scope: tuple[str | None, ...] = ()

    @property
    def allow_null(self) -> bool:
        return None in self.target_scope

    @property
    def scope_values(self) -> list[str]:
        return [v for v in self.target_scope if v is not None]

    def validate(self) -> Rules:
        """Raises on the first problem: threshold, vocabulary, exclusions, scope, in this order."""
        if math.isnan(self.threshold) or not 0.0 <= self.threshold <= 1.0:
            raise ConfigError(f"threshold must be between 0 and 1, not {self.threshold}")
        matches = [m for e in self.redundancy_exclusions for m in e.matches]
        for what, values in (("reference_values", self.reference_values), ("redundancy_exclusions matches", matches), ("scope", self.scope_values)):
            for value in values:
                if value not in RESOURCE_TYPES_GENERAL:
                    raise ConfigError(f"{what}: unknown resourceTypeGeneral {value!r}")
        return self


def _strings(values: Any, what: str) -> tuple[str, ...]:
    if not isinstance(values, list) or not all(isinstance(v, str) for v in values):
        raise ConfigError(f"{what} must be a list of strings")
    return tuple(values)


def rules_from(data: Any) -> Rules:
    """Rules of parsed YAML. All five top-level keys are required; unknown keys are ignored.

    YAML 1.1 reads bare words such as `on` or `no` as booleans; they are refused here rather than misread.
    """
    if not isinstance(data, dict):
        raise ConfigError("rules must be a mapping")
    for key in ("threshold", "reference_values", "typo_corrections", "redundancy_exclusions", "scope"):
        if key not in data:
            raise ConfigError(f"missing field `{key}`")
    typos = data["typo_corrections"]
    if not isinstance(typos, dict) or not all(isinstance(x, str) for pair in typos.items() for x in pair):
        raise ConfigError("typo_corrections must map strings to strings")
    if isinstance(data["threshold"], bool) or not isinstance(data["threshold"], (int, float)):
        raise ConfigError("threshold must be a number")
    try:
        exclusions = tuple(Exclusion(_strings(e["normalized"], "normalized"), _strings(e["matches"], "matches")) for e in data["redundancy_exclusions"])
        scope = data["scope"]["target_resource_type_general"]
    except (KeyError, TypeError) as error:
        raise ConfigError(f"missing or malformed field {error}") from error
    _strings([v for v in scope if v is not None], "scope")
    return Rules(float(data["threshold"]), _strings(data["reference_values"], "reference_values"), dict(typos), exclusions, tuple(scope)).validate()


def load_rules(path: str | Path) -> Rules:
    try:
        return rules_from(yaml.safe_load(Path(path).read_text(encoding="utf-8")))
    except (OSError, yaml.YAMLError, ConfigError) as error:
        raise ConfigError(f"rules {path}: {error}") from error
