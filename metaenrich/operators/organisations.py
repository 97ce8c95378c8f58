"""Affiliations and funders: names in records resolved to organisation identifiers.

The JSON paths are the public metadata shapes attributes.creators[].affiliation[] and
attributes.fundingReferences[]; action, emitted values and what happens to entries that have an identifier already (they
are skipped) are this engine's own decisions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions.splice import quoted, raw_cut, raw_elements, raw_list_cut
from ..sources.registry import crosswalk
from .lookup import Resolver
from .method import Action, EnrichmentMethod

SCHEME = "ROR"
SCHEME_URI = "https://ror.org"


def _listed(creator: Column) -> Column:
    """The affiliations of a creator (JSON text)."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(creator), "$.affiliation", "array<variant>"), F.array().cast("array<variant>"))


def _with_matches(rows: DataFrame, lookups: DataFrame) -> DataFrame:
    """rows with the id of their input, if it has one.

    One input may hold a third of all rows: its hash as a second key gives the matches an exchange of their own, so that
    adaptive execution may split the input's rows, or broadcast the matches where they prove small.
    """
    keyed = lambda frame: frame.withColumn("__hash", F.xxhash64("input"))
    return keyed(rows).join(keyed(lookups.select("input", "id")), ["input", "__hash"], "left").drop("__hash")


class _Organisations(EnrichmentMethod):
    def __init__(self, resolver: Resolver, registry: DataFrame):
        self.resolver, self.registry = resolver, registry

    def describe(self) -> str:
        """The resolver's settings and a checksum of the registry's rows."""
        n, check = self.registry.agg(F.count("*"), F.sum(F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)"))).first()
        return f"{super().describe()}, {self.resolver.describe()}, {n} organisations {check}"

    def inputs(self, extracted: DataFrame) -> DataFrame:
        return extracted.where("skip_reason is null").select("input").distinct()

    def lookup(self, inputs: DataFrame) -> DataFrame:
        """Matches whose identifier the registry has."""
        return self.resolver.resolve(inputs).join(self.registry.select("id", "name"), "id")

    def prepare(self, parsed: DataFrame) -> DataFrame:
        """doi, and the texts of the elements of the method's list, as they stand in the line ([] where there is no list)."""
        listed = F.try_variant_get("record", f"$.attributes.{self.field}", "array<variant>").isNotNull()
        items = raw_elements(F.when(listed, F.col("value")), "attributes", self.field)
        return parsed.select("file", "ok", R.text_at(F.col("record"), "$.id").alias("doi"), items.alias("items"))


class Affiliations(_Organisations):
    """Creators' affiliations without identifier get one; an affiliation may be a string or an object.

    The creator is emitted whole: a matched affiliation is replaced where it stands (it keeps its name and whatever else
    it has), all others, their order and their repeats stay.
    """

    field = "creators"

    def extract(self, records: DataFrame) -> DataFrame:
        """A row for each affiliation of each creator (or one without); place tells creators of equal content apart."""
        rows = records.select("doi", F.explode_outer("items").alias("creator")).withColumn("place", F.monotonically_increasing_id())
        rows = rows.select("doi", "place", "creator", F.posexplode_outer(_listed(F.col("creator"))).alias("pos", "aff"))
        name = F.coalesce(R.text_at(F.col("aff"), "$"), R.text_at(F.col("aff"), "$.name"))
        known = R.text_at(F.col("aff"), "$.affiliationIdentifier").isNotNull()
        reason = F.when(F.coalesce(F.trim(name), F.lit("")) == "", "no_affiliation").when(known, "has_identifier").when(F.coalesce(F.col("doi"), F.lit("")) == "", "no_doi")
        return rows.select("doi", "place", "creator", "pos", name.alias("input"), reason.alias("skip_reason"))

    def map_back(self, extracted: DataFrame, lookups: DataFrame | None) -> DataFrame:
        """One part a creator with a match: the creator before, and with the identifiers in place."""
        found = _with_matches(extracted.where("skip_reason is null"), lookups).where("id is not null")
        creators = found.groupBy("doi", "place").agg(F.map_from_entries(F.collect_list(F.struct("pos", "id"))).alias("ids"), F.any_value("creator").alias("creator"))
        cut = creators.select("doi", "ids", raw_list_cut(F.col("creator"), "affiliation", "name", "affiliationIdentifier", affiliationIdentifierScheme=SCHEME, schemeUri=SCHEME_URI).alias("c"))
        made = F.transform("c.items", lambda a, i: F.when(F.map_contains_key("ids", i), F.concat(a["before"], quoted(F.col("ids")[i]), a["behind"])).otherwise(a["raw"]))
        enriched = F.concat("c.before", F.array_join(made, ","), "c.behind")
        return cut.select("doi", F.lit(Action.UPDATE_CHILD.value).alias("action"), F.col("c.whole").alias("original"), enriched.alias("enriched"))


class Funders(_Organisations):
    """Funding references get the organisation's identifier: by crosswalk from a funder identifier, else by name."""

    field = "fundingReferences"

    def extract(self, records: DataFrame) -> DataFrame:
        rows = records.select("doi", F.explode_outer("items").alias("text")).select("doi", "text", F.try_parse_json("text").alias("ref"))
        name, scheme = R.text_at(F.col("ref"), "$.funderName"), R.text_at(F.col("ref"), "$.funderIdentifierType")
        number = F.regexp_extract(R.text_at(F.col("ref"), "$.funderIdentifier"), r"(?:10\.13039/)?([0-9]{6,})/?$", 1)
        reason = F.when(scheme.eqNullSafe(SCHEME), "has_identifier").when(F.coalesce(F.trim(name), F.lit("")) == "", "no_funder").when(F.coalesce(F.col("doi"), F.lit("")) == "", "no_doi")
        return rows.select("doi", "text", name.alias("input"), F.when(number != "", number).alias("funder"), reason.alias("skip_reason"))

    def map_back(self, extracted: DataFrame, lookups: DataFrame | None) -> DataFrame:
        rows = extracted.where("skip_reason is null")
        walk = crosswalk(self.registry).groupBy("external_id").agg(F.min("id").alias("walked"))
        rows = _with_matches(rows, lookups).join(walk, rows.funder == walk.external_id, "left")
        found = rows.withColumn("id", F.coalesce("walked", "id")).where("id is not null")
        cut = found.select("doi", "id", raw_cut(F.col("text"), "funderIdentifier", funderIdentifierType=SCHEME).alias("c"))
        return cut.select("doi", F.lit(Action.UPDATE_CHILD.value).alias("action"), F.col("c.whole").alias("original"), F.concat("c.before", quoted(F.col("id")), "c.behind").alias("enriched")).distinct()
