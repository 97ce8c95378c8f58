"""The engine's registered queries."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions import text as T
from ..operators.matching import match, match_distinct
from ..operators.lookup import RegistryResolver
from ..operators.organisations import Affiliations, Funders
from ..operators.provenance import CONTRIBUTOR_DDL, RESOURCE_DDL, Affiliation, Contributor, NameIdentifier, Provenance, Resource, file_problems, record_column
from ..operators.resource_type import ResourceTypeGeneral, in_scope
from ..operators.rules import Rules
from ..operators.schema import JsonSchema, builtin_schema, record_errors, validate_json
from ..sources.corpus import configure, parse, read_lines
from ..sources.gzip_lines import as_it_is, between
from ..sources.registry import crosswalk, read_registry
from ..sources.scratch import Scratch, setting
from . import oracles
from .runner import RunOptions, run
from .staged import Stage, WorkDir, due_stages, run_stages, stages_to_run
from .views import GENERAL, LABELS, OTHER, SUFFIXES, customers, keys, large_references, lines, lookup_lines, organisations, pick, shipped_rules, texts

PROVENANCE = Provenance(
    (
        Contributor("Example Organisation", "Organizational", None, "Producer", None, None, (NameIdentifier("https://example.org/1", "ROR"),), (Affiliation("Example Group"),)),
        Contributor("Doe, Jane", "Personal", "en", "DataCurator", "Jane", "Doe"),
    ),
    (Resource("10.0000/example", "DOI", "IsDocumentedBy", None, None, "Project"), Resource("https://example.org/dataset", "URL", "IsDerivedFrom", None, None, "Dataset")),
)


#: Contributors that a record may have, and whether their shape is right.
NESTED = (
    ('{"name":"X","contributorType":"Producer"}', True),
    ('{"name":"X","contributorType":"Nobody"}', False),
    ('{"name":"X","contributorType":"Producer","nameType":null,"lang":"en"}', True),
    ('{"name":"X","contributorType":"Producer","nameType":"Robot"}', False),
    ('{"name":7,"contributorType":"Producer"}', False),
    ('{"name":"X"}', False),
    ('{"name":"X","contributorType":"Producer","odd":1}', False),
    ('{"name":"X","contributorType":"Producer","affiliation":[{"name":"G"}],"nameIdentifiers":[{"nameIdentifier":"1","nameIdentifierScheme":"ROR"}]}', True),
    ('{"name":"X","contributorType":"Producer","affiliation":[{"affiliationIdentifier":"1"}]}', False),
    ('{"name":"X","contributorType":"Producer","affiliation":["G"]}', False),
    ('{"name":"X","contributorType":"Producer","nameIdentifiers":[{"nameIdentifier":"1"}]}', False),
    ('"X"', False),
)
RESOURCES = (
    '{"relatedIdentifier":"a","relationType":"IsDerivedFrom","relatedIdentifierType":"DOI"}',
    '{"relatedIdentifier":"a","relationType":"IsDerivedFrom","relatedIdentifierType":"DOI","resourceTypeGeneral":"Dataset"}',
    '{"relatedIdentifier":"a","relationType":"Wrong","relatedIdentifierType":"DOI"}',
    '{"relatedIdentifier":"a","relationType":"IsDerivedFrom","relatedIdentifierType":"DOI","schemeUri":null}',
    '{"relationType":"IsDerivedFrom","relatedIdentifierType":"DOI"}',
)
_GOOD = {
    "contributors": [{"name": "Example Organisation", "nameType": "Organizational", "contributorType": "Producer"}],
    "resources": [{"relatedIdentifier": "a", "relatedIdentifierType": "DOI", "relationType": "IsDocumentedBy", "resourceTypeGeneral": "Project"}, {"relatedIdentifier": "b", "relatedIdentifierType": "URL", "relationType": "IsDerivedFrom", "resourceTypeGeneral": "Dataset"}],
}
PROVENANCE_CASES = (
    ("good", _GOOD, "Example Organisation"),
    ("other producer", _GOOD, "Somebody Else"),
    ("no producer", _GOOD | {"contributors": [{"name": "X", "nameType": "Personal", "contributorType": "Producer"}]}, None),
    ("unknown types", _GOOD | {"contributors": [*_GOOD["contributors"], {"name": "X", "nameType": "Robot", "contributorType": "Nobody"}]}, None),
    ("unknown relations", _GOOD | {"resources": [*_GOOD["resources"], {"relatedIdentifier": "c", "relatedIdentifierType": "XYZ", "relationType": "Wrong", "resourceTypeGeneral": "Thing"}]}, None),
    ("nothing", {"contributors": [], "resources": []}, None),
    ("no project", _GOOD | {"resources": _GOOD["resources"][1:]}, None),
    ("unknown key", _GOOD | {"contributors": [{"nam": "X"}]}, None),
    ("missing part", {"contributors": []}, None),
)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(lines(spark, sf_dir))


def _prepared(spark: SparkSession, sf_dir: str) -> tuple[ResourceTypeGeneral, DataFrame]:
    """What the method reads of each line, written once: the lines are scanned and parsed once, whatever follows."""
    method = ResourceTypeGeneral(shipped_rules())
    return method, Scratch(spark, "records").save(method.prepare(_parsed(spark, sf_dir)), "prepared")


def _extracted(spark: SparkSession, sf_dir: str) -> tuple[ResourceTypeGeneral, DataFrame]:
    method, prepared = _prepared(spark, sf_dir)
    return method, method.extract(prepared.where("ok"))


def strict_parse_counts(spark, sf_dir):
    return _parsed(spark, sf_dir).agg(F.count_if("ok").alias("records_scanned"), F.count_if(~F.col("ok")).alias("lines_malformed"))


def typed_string_paths(spark, sf_dir):
    at = lambda path: R.text_at(F.col("record"), path)
    types = F.try_variant_get("record", "$.attributes.types", "variant")
    return _parsed(spark, sf_dir).where("ok").select(at("$.id").alias("doi"), at("$.attributes.types.resourceType").alias("free"), at("$.attributes.types.resourceTypeGeneral").alias("general"), R.is_object(types).alias("is_types"))


def event_props_types(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", R.strict(F.col("props")).alias("p"))
    return events.select("event_id", F.col("p.ok").alias("ok"), R.is_object(F.col("p.record")).alias("is_object"), R.text_at(F.col("p.record"), "$.k").alias("k_text"), F.try_variant_get("p.record", "$.k", "bigint").alias("k_number"))


def smart_normalize(spark, sf_dir):
    return texts(spark, sf_dir).select("t", T.normalize(F.col("t"), shipped_rules().typo_corrections).alias("n"))


def camel_tokens(spark, sf_dir):
    return texts(spark, sf_dir).select("t", F.array_join(T.camel_tokens(F.col("t")), "|").alias("tokens"))


def camel_concat(spark, sf_dir):
    """The third key of a match, and whether it differs from the first one's: it never does, so rate() leaves it out."""
    typos = shipped_rules().typo_corrections
    rows = texts(spark, sf_dir).select("t", T.camel_concat(F.col("t"), typos).alias("n"), T.normalize(F.col("t"), {}).alias("plain"))
    return rows.select("t", "n", (T.normalize(F.col("n"), {}) == F.col("plain")).alias("same"))


def levenshtein_ratio(spark, sf_dir):
    """Every distinct text against every reference value."""
    refs = F.explode(F.array(*map(F.lit, shipped_rules().reference_values)))
    return texts(spark, sf_dir).select("t", refs.alias("ref")).select("t", "ref", F.round(T.similarity(F.lower("t"), F.lower("ref")), 6).alias("ratio"))


def fuzzy_match(spark, sf_dir):
    return match_distinct(texts(spark, sf_dir), "t", shipped_rules())


def part_type_match(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type")
    return match(part, "p_type", shipped_rules()).select("p_partkey", "p_type", "matched", "outcome")


def large_vocabulary_match(spark, sf_dir):
    """The orders' labels, each with the name of a kind, matched to a vocabulary that an index holds."""
    rules = shipped_rules()
    large = Rules(rules.threshold, large_references(rules), rules.typo_corrections)
    k = F.col("k")
    labelled = keys(spark, sf_dir).select(F.concat(pick(LABELS, k), F.lit(" "), pick(SUFFIXES[:7], k)).alias("t"))
    return match_distinct(labelled, "t", large)


def redundancy_filter(spark, sf_dir):
    return match_distinct(texts(spark, sf_dir), "t", shipped_rules()).where(F.col("outcome") == "redundant").select("t")


def scope_filter(spark, sf_dir):
    rows = _parsed(spark, sf_dir).where("ok").select(R.text_at(F.col("record"), "$.attributes.types.resourceTypeGeneral").alias("general"))
    return rows.groupBy("general").agg(F.count("*").alias("n"), F.bool_and(in_scope(F.col("general"), shipped_rules())).alias("in_scope"))


def skip_reason_counts(spark, sf_dir):
    _, extracted = _extracted(spark, sf_dir)
    return extracted.groupBy(F.coalesce("skip_reason", F.lit("emitted")).alias("reason")).agg(F.count("*").alias("n"))


def reclassify_emitted(spark, sf_dir):
    _, extracted = _extracted(spark, sf_dir)
    return extracted.where("skip_reason is null").select("doi", "free", "general", "matched")


def enriched_types_json(spark, sf_dir):
    method, extracted = _extracted(spark, sf_dir)
    return method.map_back(extracted)


def enrichment_records(spark, sf_dir):
    method, extracted = _extracted(spark, sf_dir)
    return method.map_back(extracted).select("doi", record_column(PROVENANCE, method.field).alias("value"))


def _variants(spark, sf_dir):
    """Parts of customers, of which some break a rule: (k, value)."""
    k = F.col("c_custkey")
    rows = customers(spark, sf_dir).select(
        k.alias("k"),
        F.concat(F.lit("10.1/"), k).alias("doi"),
        F.get(F.array(*map(F.lit, ("update", "updateChild", "insert", "deleteChild", "replace"))), (k % 5).cast("int")).alias("action"),
        F.get(F.array(*map(F.lit, ('{"a":1}', '"x"', "7", "[1]", "true", "null"))), (k % 6).cast("int")).alias("original"),
        F.when(k % 7 != 0, F.lit('{"b":2}')).alias("enriched"),
    )
    value = F.when(k % 3 == 0, record_column(PROVENANCE, "types")).otherwise(record_column(PROVENANCE, "nonsense"))
    return rows.withColumn("c_custkey", F.col("k")).select("k", value.alias("value"))


def record_validation(spark, sf_dir):
    configure(spark)
    return _variants(spark, sf_dir).select("k", F.array_join(F.array_sort(record_errors("value")), ",").alias("errors"))


def _provenance_files(spark, sf_dir):
    """A provenance file a supplier (k, case, value), whose producer is named after it; of nine kinds, most of them wrong."""
    k = F.col("s_suppkey")
    named = F.replace(pick(tuple(json.dumps(data) for _, data, _ in PROVENANCE_CASES), k), F.lit("Example Organisation"), F.concat(F.lit("Organisation "), k.cast("string")))
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(k.alias("k"), (k % len(PROVENANCE_CASES)).cast("int").alias("case"), named.alias("value"))
    required = [F.when(F.col("case") == i, F.lit(name)) for i, (_, _, name) in enumerate(PROVENANCE_CASES) if name and name != "Example Organisation"]
    own = F.when(F.col("case") == 0, F.concat(F.lit("Organisation "), F.col("k").cast("string")))
    return rows.withColumn("organization", F.coalesce(own, *required))


def provenance_flatten(spark, sf_dir):
    """Contributors and resources of the suppliers' provenance files, an entry a row."""
    files = _provenance_files(spark, sf_dir).select("k", F.from_json("value", f"contributors {CONTRIBUTOR_DDL}, resources {RESOURCE_DDL}").alias("p"))
    who = files.select("k", F.posexplode("p.contributors")).select("k", F.lit("contributor").alias("kind"), "pos", F.col("col.name").alias("name"), F.col("col.contributorType").alias("type"))
    what = files.select("k", F.posexplode("p.resources")).select("k", F.lit("resource"), "pos", "col.relatedIdentifier", "col.relationType")
    return who.union(what)


def nested_validation(spark, sf_dir):
    """Shapes of contributors and resources: a record a customer, some with a nested entry that breaks a rule."""
    configure(spark)
    k = F.col("c_custkey")
    contributor = pick(tuple(c for c, _ in NESTED), k)
    value = F.concat(F.lit('{"doi":"10.1/x","contributors":['), contributor, F.lit('],"resources":['), pick(RESOURCES, k), F.lit('],"action":"insert","field":"types","enrichedValue":{}}'))
    return customers(spark, sf_dir).select(k.alias("k"), value.alias("value")).select("k", F.array_join(F.array_sort(record_errors("value")), ",").alias("errors"))


def schema_validation(spark, sf_dir):
    """The same records by the compiled schema: which are valid."""
    configure(spark)
    return validate_json(_variants(spark, sf_dir), JsonSchema(builtin_schema())).select("k", (F.size("errors") == 0).alias("valid"))


def provenance_problems(spark, sf_dir):
    """Everything that is wrong with the suppliers' provenance files: one row a problem, in their order."""
    found = file_problems(_provenance_files(spark, sf_dir), "k")
    return found.withColumn("problem", F.regexp_replace("problem", "(?s)(\n|, expected).*", ""))


def _registry(spark, sf_dir):
    """The registry, written as a dump (one list in one file) and read from there; what is read is written, as all steps need it."""
    scratch = Scratch(spark, "registry")
    line = lambda text: spark.createDataFrame([(text,)], "value string")
    body = organisations(spark, sf_dir).select(F.concat(F.to_json(F.struct("*")), F.lit(",")).alias("value"))
    line("[").union(body).union(line("null]")).coalesce(1).write.text(scratch.path("dump"))
    return scratch.save(read_registry(spark, scratch.path("dump"), ".txt"), "read")


def registry_names(spark, sf_dir):
    return _registry(spark, sf_dir).select("id", "name", F.size("names").alias("n_names"))


def crosswalk_join(spark, sf_dir):
    return crosswalk(_registry(spark, sf_dir))


def _lookup(spark, sf_dir, kind):
    """(method, extracted rows, matches) of a lookup method over the lookup records; each step is written, as in a run."""
    registry = _registry(spark, sf_dir)
    method, scratch = kind(RegistryResolver(registry), registry), Scratch(spark, "lookup")
    prepared = method.prepare(parse(lookup_lines(spark, sf_dir))).where("ok")
    extracted = scratch.save(method.extract(prepared), "extracted")
    return method, extracted, scratch.save(method.lookup(method.inputs(extracted)), "matches")


def distinct_inputs(spark, sf_dir):
    method, extracted, _ = _lookup(spark, sf_dir, Affiliations)
    return method.inputs(extracted)


def registry_matches(spark, sf_dir):
    """Equal names, else the most similar one."""
    return _lookup(spark, sf_dir, Affiliations)[2].select("input", "id", "name", F.round("score", 6).alias("score"))


def similar_names(spark, sf_dir):
    """Customers' spellings of registry names, each without one letter or with a wrong one, to the most similar name."""
    c = F.col("c_custkey")
    name = F.concat(F.lit("Institute of Topic "), (c % 90).cast("string"), F.lit(" Studies"))
    at = (c % 20 + 1).cast("int")
    spelt = F.concat(F.substring(name, F.lit(1), at), F.when(c % 2 == 0, "x").otherwise(""), F.substring(name, at + 2, F.lit(100)))
    inputs = spark.read.parquet(f"{sf_dir}/customer.parquet").select(spelt.alias("input")).distinct()
    return RegistryResolver(_registry(spark, sf_dir)).resolve(inputs).withColumn("score", F.round("score", 6))


def unmatched_inputs(spark, sf_dir):
    method, extracted, matches = _lookup(spark, sf_dir, Affiliations)
    return method.inputs(extracted).join(matches, "input", "left_anti")


def affiliation_skips(spark, sf_dir):
    return _lookup(spark, sf_dir, Affiliations)[1].groupBy(F.coalesce("skip_reason", F.lit("asked")).alias("reason")).agg(F.count("*").alias("n"))


def reconcile_join(spark, sf_dir):
    """Affiliations: the matches back in the creators' records."""
    method, extracted, matches = _lookup(spark, sf_dir, Affiliations)
    return method.map_back(extracted, matches)


def funder_parts(spark, sf_dir):
    """Funders: by crosswalk from a funder number, else by name."""
    method, extracted, matches = _lookup(spark, sf_dir, Funders)
    return method.map_back(extracted, matches)


def staged_run(spark, sf_dir):
    """A lookup run in stages: parts and due stages of a first run, a second one, and one whose query stage is reopened."""
    registry = _registry(spark, sf_dir)
    method, work = Affiliations(RegistryResolver(registry), registry), WorkDir(spark, Scratch(spark, "work").path("stages"))
    records = method.prepare(parse(lookup_lines(spark, sf_dir))).where("ok")
    rows = []

    def step(name, **options):
        due = ",".join(s.value for s in stages_to_run(work, options.get("from_scratch", False)))
        parts = run_stages(method, records, work, **options)
        rows.append((name, due, parts.count() if parts is not None else 0, all(work.is_complete(s) for s in Stage)))

    step("first")
    step("second")
    work.unmark(Stage.QUERY)
    step("reopened")
    step("only extract", only=Stage.EXTRACT)
    step("only reconcile", only=Stage.RECONCILE)
    step("from scratch", from_scratch=True)
    return spark.createDataFrame(rows, "step string, due string, parts bigint, complete boolean")


def corpus_run(spark, sf_dir):
    """A whole run over gzipped files in nested folders, with blank lines and a file that is no gzip: its report and output."""
    scratch = Scratch(spark, "corpus")
    rows = lines(spark, sf_dir).select(F.explode(F.when(F.col("k") % 23 == 0, F.array("value", F.lit(""), F.lit("  "))).otherwise(F.array("value"))).alias("value"))
    rows.repartition(3).write.text(scratch.path("in/updated_2024-01"), compression="gzip")
    spark.createDataFrame([("not gzip",)], "value string").coalesce(1).write.text(scratch.path("in/broken"))
    system, path = scratch.file_system()
    for name in ("in/updated_2024-01", "in/broken"):
        for status in system.listStatus(path(name)):
            file = status.getPath()
            if file.getName().startswith("part-"):
                system.rename(file, path(f"{name}/{file.getName().split('.')[0]}.jsonl.gz"))
    stats = run(spark, ResourceTypeGeneral(shipped_rules()), RunOptions(scratch.path("in"), scratch.path("out")), PROVENANCE)
    empty = run(spark, ResourceTypeGeneral(shipped_rules()), RunOptions(scratch.path("nothing"), scratch.path("out-empty")), PROVENANCE)
    rows = [
        (name, s.files_processed, s.files_failed, s.records_scanned, s.lines_malformed, s.emitted, s.written, s.invalid, sum(s.skipped.values()), spark.read.text(scratch.path(out)).count())
        for name, s, out in (("corpus", stats, "out"), ("empty", empty, "out-empty"))
    ]
    return spark.createDataFrame(rows, "name string, files_processed int, files_failed int, records_scanned bigint, lines_malformed bigint, emitted bigint, written bigint, invalid bigint, skipped bigint, lines_out bigint")


def stage_plan(spark, sf_dir):
    """Which stages are due for work directories in the state that the customers' keys give them."""
    k = F.col("c_custkey")
    done = {Stage.EXTRACT: k % 2 == 0, Stage.QUERY: k % 3 == 0, Stage.RECONCILE: k % 5 == 0}
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("k"), F.array_join(due_stages(done, k % 7 == 0), ",").alias("stages"))


def file_verdicts(spark, sf_dir):
    """A corpus of five gzip files, of which two are damaged: what one pass says of each, and the lines that it got."""
    scratch = Scratch(spark, "verdicts")
    rows = lines(spark, sf_dir).select((F.col("k") % 5).alias("part"), "value")
    # A file a part, written as its rows come: sorted by part, a task would hold all of them.
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "5"):
        rows.repartition(5, "part").write.partitionBy("part").text(scratch.path("in/whole"), compression="gzip")
    # Part 3 is cut in its middle, part 4 loses its first bytes; either is read and written in pieces, in one pass.
    for part, start in ((3, 0), (4, 4)):
        pieces = spark.read.option("lineSep", "\n").options(**as_it_is(".gz")).text(scratch.path(f"in/whole/part={part}"))
        size = F.col("_metadata.file_size")
        end = F.floor(size / 2) if part == 3 else size
        cut = pieces.select(F.lit(start).cast("bigint").alias("start"), end.cast("bigint").alias("end"), F.col("value").cast("binary").alias("piece"))
        cut.mapInArrow(between, "value string").write.text(scratch.path(f"in/damaged/part={part}"))
    scratch.drop("in/whole/part=3", "in/whole/part=4")
    system, path = scratch.file_system()
    for name in (*(f"in/whole/part={i}" for i in range(3)), "in/damaged/part=3", "in/damaged/part=4"):
        for status in system.listStatus(path(name)):
            if status.getPath().getName().startswith("part-"):
                system.rename(status.getPath(), path(f"{name}/all.jsonl.gz"))
    read = scratch.save(read_lines(spark, scratch.path("in")).where("file is not null"), "read")
    bad = F.col("file.damage").isNotNull()
    return read.select(F.regexp_extract("file.path", "part=([0-9])", 1).cast("int").alias("part"), (~bad).alias("whole"), F.when(~bad, F.col("file.lines")).alias("lines"))


def run_counters(spark, sf_dir):
    method, prepared = _prepared(spark, sf_dir)
    totals = prepared.agg(F.count_if("ok").alias("records_scanned"), F.count_if(~F.col("ok")).alias("lines_malformed"))
    out = method.extract(prepared.where("ok")).agg(F.count_if(F.col("skip_reason").isNull()).alias("emitted"), F.count("skip_reason").alias("skipped"))
    return totals.join(F.broadcast(out))  # one row each


_QUERIES = (
    strict_parse_counts, typed_string_paths, event_props_types, smart_normalize, camel_tokens, camel_concat, levenshtein_ratio, fuzzy_match, part_type_match, large_vocabulary_match, redundancy_filter, scope_filter,
    skip_reason_counts, reclassify_emitted, enriched_types_json, enrichment_records, record_validation, nested_validation, schema_validation, provenance_flatten, provenance_problems,
    registry_names, crosswalk_join, distinct_inputs, registry_matches, similar_names, unmatched_inputs, affiliation_skips, reconcile_join, funder_parts, staged_run, stage_plan, run_counters, corpus_run, file_verdicts,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    from ..operators.provenance import as_json

    head = {"contributors": as_json(PROVENANCE.contributors), "resources": as_json(PROVENANCE.resources)}
    return oracles.build(shipped_rules(), LABELS, GENERAL, OTHER, tuple(data for _, data, _ in PROVENANCE_CASES), json.dumps(head, separators=(",", ":"))[1:-1], tuple(ok for _, ok in NESTED))
