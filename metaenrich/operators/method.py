"""Extension interface: an enrichment method is a set of frame-to-frame steps."""

from __future__ import annotations

from abc import ABC, abstractmethod
from enum import Enum

from pyspark.sql import DataFrame


class Action(str, Enum):
    UPDATE = "update"
    UPDATE_CHILD = "updateChild"
    INSERT = "insert"
    DELETE_CHILD = "deleteChild"


class EnrichmentMethod(ABC):
    """Derives corrections of one top-level field.

    prepare() gets parsed lines (value, file, ok, record) and keeps file, ok and what the method reads: a narrow table that
    the runner writes once, so that a corpus is scanned and parsed once (rows with a file's verdict pass without ok). extract() gets the rows of it that are ok and returns
    skip_reason (null: emitted) and whatever columns the next steps need; lookup() resolves distinct inputs, if the method
    has any; map_back() turns extracted rows into parts: doi, action, original and enriched (JSON text or null).
    """

    @property
    @abstractmethod
    def field(self) -> str: ...

    def describe(self) -> str:
        """What its results depend on besides the records, as text: stages made with something else are made again."""
        return f"{type(self).__name__} {self.field}"

    def prepare(self, parsed: DataFrame) -> DataFrame:
        return parsed

    @abstractmethod
    def extract(self, records: DataFrame) -> DataFrame: ...

    def inputs(self, extracted: DataFrame) -> DataFrame | None:
        """Distinct inputs (column input) to look up; None if the method looks nothing up."""
        return None

    def lookup(self, inputs: DataFrame) -> DataFrame:
        """Matches of inputs; by default nothing matches."""
        return inputs.limit(0)

    @abstractmethod
    def map_back(self, extracted: DataFrame, lookups: DataFrame | None) -> DataFrame: ...
