"""Reclassification of attributes.types.resourceTypeGeneral from the free-text resourceType."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions.splice import quoted, raw_at, raw_cut
from .matching import join_rated, match_distinct
from .method import Action, EnrichmentMethod
from .rules import Rules

SKIP_ORDER = ("malformed_types", "not_in_scope", "no_resource_type", "no_match", "redundant", "no_change", "no_doi")


def in_scope(general: Column, rules: Rules) -> Column:
    """Null counts if the scope lists null; a value if it is listed, case and all ('' is a value)."""
    member = F.coalesce(general.isin(rules.scope_values), F.lit(False)) if rules.scope_values else F.lit(False)
    return (general.isNull() & F.lit(rules.allow_null)) | member


def classify(rows: DataFrame, rules: Rules) -> DataFrame:
    """Adds matched and skip_reason to rows of (is_types, general, free, doi).

    Only in-scope rows with a free text take part in the match; the first reason that applies wins.
    """
    open_ = F.col("is_types") & in_scope(F.col("general"), rules) & (F.coalesce(F.col("free"), F.lit("")) != "")
    # Never null: a null key would make the optimizer repeat all of the above in a filter below the join.
    rows = rows.withColumn("__free", F.coalesce(F.when(open_, F.col("free")), F.lit("")))
    rated = match_distinct(rows, "__free", rules)
    reason = (
        F.when(~F.col("is_types"), "malformed_types")
        .when(~in_scope(F.col("general"), rules), "not_in_scope")
        .when(F.col("__free") == "", "no_resource_type")
        .when(F.col("outcome").isNotNull(), F.col("outcome"))
        .when(F.col("matched").eqNullSafe(F.col("general")), "no_change")
        .when(F.coalesce(F.col("doi"), F.lit("")) == "", "no_doi")
    )
    return join_rated(rows, rated, "__free").withColumn("skip_reason", reason).drop("__free", "outcome")


class ResourceTypeGeneral(EnrichmentMethod):
    field = "types"

    def __init__(self, rules: Rules):
        self.rules = rules

    def describe(self) -> str:
        return repr(self.rules)

    def prepare(self, parsed: DataFrame) -> DataFrame:
        """Typed fields of each line, and the text of the types object, as it stands in the line, of those that might be emitted."""
        types = F.try_variant_get("record", "$.attributes.types", "variant")
        rows = parsed.select(
            "value",
            "file",
            "ok",
            R.is_object(types).alias("is_types"),
            R.text_at(F.col("record"), "$.attributes.types.resourceTypeGeneral").alias("general"),
            R.text_at(F.col("record"), "$.attributes.types.resourceType").alias("free"),
            R.text_at(F.col("record"), "$.id").alias("doi"),
        )
        open_ = F.col("ok") & F.col("is_types") & in_scope(F.col("general"), self.rules) & F.col("free").isNotNull()
        # Texts of other lines don't cross to Python.
        types = raw_cut(raw_at(F.when(open_, F.col("value")), "attributes", "types"), "resourceTypeGeneral")
        return rows.select("file", "ok", "is_types", "general", "free", "doi", types.alias("types"))

    def extract(self, records: DataFrame) -> DataFrame:
        return classify(records, self.rules)

    def map_back(self, extracted: DataFrame, lookups: DataFrame | None = None) -> DataFrame:
        """Original and enriched types of the emitted rows: the source text, and with the new value in place (or last)."""
        rows = extracted.where("skip_reason is null")
        enriched = F.concat("types.before", quoted(F.col("matched")), "types.behind")
        return rows.select("doi", F.lit(Action.UPDATE.value).alias("action"), F.col("types.whole").alias("original"), enriched.alias("enriched"))
