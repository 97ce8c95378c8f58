import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from metaenrich.functions import records as R
from metaenrich.functions import splice
from metaenrich.operators.provenance import load_provenance, problems, provenance_from, record_column
from metaenrich.operators.resource_type import ResourceTypeGeneral
from metaenrich.operators.rules import ConfigError, Exclusion, Rules
from metaenrich.operators.schema import JsonSchema, builtin_schema, record_errors, validate_json
from metaenrich.plans.catalogue import PROVENANCE
from metaenrich.plans.runner import RunOptions, run
from metaenrich.plans.views import RULES_FILE, shipped_rules
from metaenrich.sources.corpus import configure, parse

CONFIGS = RULES_FILE.parent
#: Own records: free text, general type, other keys, and the type that comes out (None: the record is skipped).
GOLDEN = [
    ("Peer reveiw", "Other", {"citeproc": "review", "schemaOrg": "Review"}, "PeerReview"),
    ("PhysicalObject", "Text", {}, "PhysicalObject"),
    ("Sotfware", None, {"ris": "COMP"}, "Software"),
    ("Dissertation", "Dissertation", {}, None),
    ("TXT", "Other", {}, None),
    ("a heap of stones", "Text", {}, None),
    ("Data-Paper", None, {"bibtex": "misc"}, "DataPaper"),
    ("work flow", "Text", {}, "Workflow"),
    ("Collections", "Other", {}, "Collection"),
    ("studyRegistration", "Text", {}, "StudyRegistration"),
    ("Model", "Sound", {}, None),
]


def golden_lines():
    return [json.dumps({"id": f"10.9/r{i}", "attributes": {"types": {"resourceType": t, "resourceTypeGeneral": g, **extra}}}) for i, (t, g, extra, _) in enumerate(GOLDEN, 1)]


def write_corpus(folder, lines, name="part_0001"):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / f"{name}.jsonl.gz", "wb") as file:
        file.write(b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines) + b"\n")


@pytest.mark.parametrize(
    ("line", "ok"),
    [
        ('{"a":1}', True), ("5", True), ("null", True), ("[]", True), ('{"a":1}\r', True), ('{"a":1} xyz', False), ('{"a":1}//c', False), ('{"a":1}] junk', False),
        ('{"a":1}} junk', False), ('{"a":1},"x":2', False), ('{"a":1}],[2', False), ('1,"x":2', False), ("1,'x':2", False), ('{"a":1},{"b":2}', False), ('{"a":[{"b":1}]}', True), ('{"a":1}} ]', False), ("1] }", False), ("[1],[2]", False), ("{", False), ("01", False), ('{"a":1,"a":2}', True),
    ],
)
def test_strict_parse(spark, line, ok):
    configure(spark)
    row = spark.createDataFrame([(line,)], "v string").select(R.strict(F.col("v")).alias("p")).select("p.ok", F.col("p.record").isNotNull().alias("there")).first()
    assert row.ok is ok
    if line == '{"a":1,"a":2}':
        assert spark.createDataFrame([(line,)], "v string").select(F.try_variant_get(R.strict(F.col("v"))["record"], "$.a", "int").alias("a")).first().a == 2


@pytest.mark.parametrize(
    ("line", "exact"),
    [
        (r'"\ud800"', False), (r'"\uD83D\uDE00"', True), (r'"\ude00"', False), (r'"\ud83dx\ude00"', False), (r'"\ud83d\ud83d\ude00"', False), (r'"\\ud800"', True), (r'"\\\ud800"', False),
        (r'"\ud83d\\ude00"', False), (r'{"a":["\ud83d\ude00","\u00e9"]}', True), ("1e400", False), ("-1E+309", False), ("[1e308]", True), ("1.8e308", False), ("1e-400", True), ('"1e400"', True), (r'"\"1e400"', True), ('{"a":"x","b":1e999}', False),
        ("9" * 309, False), ("1" + "0" * 308, True), ("0." + "9" * 400, True), ("1" + "0" * 290 + "e20", False),
    ],
)
def test_exact_parsing_refuses_lone_surrogates_and_vast_numbers(spark, line, exact):
    configure(spark)
    row = spark.createDataFrame([(line,)], "v string").select(R.strict(F.col("v"))["ok"].alias("plain"), R.strict(F.col("v"), exact=True)["ok"].alias("exact")).first()
    assert (row.plain, row.exact) == (True, exact)


def test_text_at_takes_strings_only(spark):
    row = spark.createDataFrame([('{"a":7,"b":"x","c":"","d":null}',)], "v string").select(*[R.text_at(F.parse_json("v"), f"$.{k}").alias(k) for k in "abcde"]).first()
    assert row.asDict() == {"a": None, "b": "x", "c": "", "d": None, "e": None}


def test_golden_records_end_to_end(spark, tmp_path):
    write_corpus(tmp_path / "in" / "updated_2024-01", golden_lines())
    stats = run(spark, ResourceTypeGeneral(shipped_rules()), RunOptions(str(tmp_path / "in"), str(tmp_path / "out")), load_provenance(CONFIGS / "provenance.yaml"))
    assert (stats.files_processed, stats.files_failed, stats.records_scanned, stats.lines_malformed, stats.emitted, stats.written) == (1, 0, 11, 0, 7, 7)
    assert stats.skipped == {"no_match": 1, "not_in_scope": 2, "redundant": 1}
    records = {r["doi"]: r for r in map(json.loads, (x.value for x in spark.read.text(str(tmp_path / "out")).collect()))}
    assert {d: r["enrichedValue"]["resourceTypeGeneral"] for d, r in records.items()} == {f"10.9/r{i}": g[3] for i, g in enumerate(GOLDEN, 1) if g[3]}
    first = records["10.9/r1"]
    assert list(first) == ["doi", "contributors", "resources", "action", "field", "originalValue", "enrichedValue"]
    assert first["originalValue"] == {"resourceType": "Peer reveiw", "resourceTypeGeneral": "Other", "citeproc": "review", "schemaOrg": "Review"}
    assert list(first["enrichedValue"]) == ["resourceType", "resourceTypeGeneral", "citeproc", "schemaOrg"]
    assert records["10.9/r3"]["originalValue"]["resourceTypeGeneral"] is None
    assert not any(JsonSchema(builtin_schema()).errors(r) for r in records.values())


def test_untouched_parts_of_a_record_keep_their_text(spark, tmp_path):
    """Order of keys, numbers, escapes and inner repeats stay as they are, wherever the edited key stands; white space goes."""
    odd = r'"z":{"b":1.0,"a":[-0.0, 1E+2,1e400,123456789012345678901234567890.10],"b":2},"\u0061\/\"x":"\u00e9\ud83d\ude00 ,:{}[]"'
    kept = r'"z":{"b":1.0,"a":[-0.0,1E+2,1e400,123456789012345678901234567890.10],"b":2},"\u0061\/\"x":"\u00e9\ud83d\ude00 ,:{}[]"'
    general = '"resourceTypeGeneral" : "Text"'
    free = '"resourceType":"Sotfware"'
    cases = [
        (f"{{{general},{odd} ,{free}}}", f'{{"resourceTypeGeneral":"Text",{kept},{free}}}', f'{{"resourceTypeGeneral":"Software",{kept},{free}}}'),
        (f"{{ {odd},{free},{general}\t}}", f'{{{kept},{free},"resourceTypeGeneral":"Text"}}', f'{{{kept},{free},"resourceTypeGeneral":"Software"}}'),
        (f"{{{free},{odd}}}", f"{{{free},{kept}}}", f'{{{free},{kept},"resourceTypeGeneral":"Software"}}'),
        (f"{{{general},{free},{general}}}", f'{{"resourceTypeGeneral":"Text",{free}}}', f'{{"resourceTypeGeneral":"Software",{free}}}'),
        (f'{{"resource\\u0054ypeGeneral":"Text",{free}}}', f'{{"resource\\u0054ypeGeneral":"Text",{free}}}', f'{{"resource\\u0054ypeGeneral":"Software",{free}}}'),
    ]
    write_corpus(tmp_path / "in", [f'{{"id":"10.9/{i}", "attributes":{{"types":{text}, "more":[{{}}]}}}}' for i, (text, _, _) in enumerate(cases)])
    run(spark, ResourceTypeGeneral(shipped_rules()), RunOptions(str(tmp_path / "in"), str(tmp_path / "out")), PROVENANCE)
    found = {json.loads(r.value)["doi"]: r.value for r in spark.read.text(str(tmp_path / "out")).collect()}
    for i, (_, before, after) in enumerate(cases):
        assert found[f"10.9/{i}"].endswith(f'"originalValue":{before},"enrichedValue":{after}}}')


def test_splicing_of_any_text():
    """Cut and put together again, a text has the value that plain JSON code gives it."""
    rng = random.Random(13)

    def value(depth=0):
        if depth > 2 or rng.random() < 0.4:
            return rng.choice([None, True, 1, -0.5, "", "a,b", '"}]', "\\", "é\n"])
        return [value(depth + 1) for _ in range(rng.randrange(4))] if rng.random() < 0.5 else {k: value(depth + 1) for k in rng.sample(["a", "b", 'c"', "{", "ü"], rng.randrange(5))}

    for _ in range(2000):
        v = value()
        text = json.dumps(v, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
        assert [json.loads(e) for e in splice.elements(text)] == (v if isinstance(v, list) else [])
        assert {k: json.loads(x) for k, (_, x) in splice.members(text).items()} == (v if isinstance(v, dict) else {})
        if isinstance(v, dict):
            before, behind = splice.cut(text, "b", {"n": '"new"'})
            assert json.loads(before + "[7]" + behind) == v | {"b": [7], "n": "new"}
            assert list(json.loads(before + "[7]" + behind)) == list(v | {"b": 0, "n": 0})


def test_edge_lines(spark, tmp_path):
    odd = [
        '{"id":7,"attributes":{"types":{"resourceType":"Dataset","resourceTypeGeneral":"Text"}}}',
        '{"id":"","attributes":{"types":{"resourceType":"Dataset","resourceTypeGeneral":"Text"}}}',
        '{"id":"a","attributes":{"types":{"resourceType":7,"resourceTypeGeneral":"Text"}}}',
        '{"id":"a","attributes":{"types":{"resourceType":"Dataset","resourceTypeGeneral":""}}}',
        '{"id":"a","attributes":{"types":{"resourceType":"Dataset","resourceTypeGeneral":5}}}',
        '{"id":"a","attributes":{"types":[1]}}', '{"id":"a","attributes":null}', "5", "null", "[]",
        '{"id":"a","attributes":{"types":{"resourceType":"  ","resourceTypeGeneral":"Text"}}}',
        '{"id":"a"} trailing', "{bad", b'{"id":"\xff\xfe"}', "", "   ",
    ]
    write_corpus(tmp_path / "in", odd)
    stats = run(spark, ResourceTypeGeneral(shipped_rules()), RunOptions(str(tmp_path / "in"), str(tmp_path / "out")), PROVENANCE)
    assert (stats.records_scanned, stats.lines_malformed, stats.emitted) == (11, 3, 1)
    assert stats.skipped == {"malformed_types": 5, "no_doi": 2, "no_resource_type": 1, "not_in_scope": 1, "no_match": 1}


@pytest.mark.parametrize(
    ("free", "general", "doi", "scope", "expected"),
    [
        ("Journal Article", "Text", "10.1/a", ("Text", None), None),
        ("Journal Article", "Image", "10.1/a", ("Text", None), "not_in_scope"),
        ("Text", "Text", "10.1/a", ("Text", None), "redundant"),
        ("nonsense words", "Text", "10.1/a", ("Text", None), "no_match"),
        ("Dataset", None, "10.1/a", ("Text", None), None),
        ("Dataset", "Dataset", "10.1/a", ("Dataset",), "no_change"),
        ("Dataset", "Text", None, ("Text", None), "no_doi"),
        ("", "Text", "10.1/a", ("Text", None), "no_resource_type"),
    ],
)
def test_single_outcomes(spark, free, general, doi, scope, expected):
    rules = Rules(0.85, ("JournalArticle", "Dataset", "Text"), {}, (Exclusion(("text", "txt"), ("Text", "Other")),), scope)
    record = {"attributes": {"types": {"resourceType": free, "resourceTypeGeneral": general}}} | ({"id": doi} if doi else {})
    configure(spark)
    method = ResourceTypeGeneral(rules)
    rows = method.prepare(parse(spark.createDataFrame([(json.dumps(record),)], "value string")))
    assert method.extract(rows).first().skip_reason == expected


def test_empty_input_leaves_empty_output(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stats = run(spark, ResourceTypeGeneral(shipped_rules()), RunOptions(str(tmp_path / "in"), str(tmp_path / "out")), PROVENANCE)
    assert stats.emitted == 0 and spark.read.text(str(tmp_path / "out")).count() == 0


def test_invalid_records_are_kept_apart(spark, tmp_path):
    write_corpus(tmp_path / "in", golden_lines())
    strict = builtin_schema()
    strict["properties"]["doi"] = {"type": "string", "enum": ["10.9/r1"]}
    stats = run(spark, ResourceTypeGeneral(shipped_rules()), RunOptions(str(tmp_path / "in"), str(tmp_path / "out"), single_file=True), PROVENANCE, JsonSchema(strict))
    assert (stats.emitted, stats.written, stats.invalid) == (7, 1, 6)
    assert spark.read.json(str(tmp_path / "out.invalid")).count() == 6


def test_provenance_problems():
    data = {
        "contributors": [{"name": "X", "nameType": "Robot", "contributorType": "Nobody"}],
        "resources": [{"relatedIdentifier": "a", "relatedIdentifierType": "DOI", "relationType": "Wrong", "resourceTypeGeneral": "Dataset"}],
    }
    found = problems(provenance_from(data))
    assert [x.split("\n")[0] for x in found] == [
        'contributors[0]: unknown contributorType "Nobody"',
        'contributors[0]: unknown nameType "Robot"',
        'resources[0]: unknown relationType "Wrong"',
        "missing required contributor: any name / Organizational / Producer",
        "missing required resource: IsDocumentedBy / Project",
        "missing required resource: IsDerivedFrom / Dataset",
    ]
    assert problems(PROVENANCE) == [] and "Someone" in problems(PROVENANCE, "Someone")[0]
    with pytest.raises(ConfigError, match="unknown field `nam`"):
        provenance_from({"contributors": [{"nam": "X"}], "resources": []})


def test_schema_rules(spark):
    value = spark.range(1).select(F.lit("10.1/x").alias("doi"), F.lit("insert").alias("action"), F.lit(None).cast("string").alias("original"), F.lit('{"a":1}').alias("enriched")).select(record_column(PROVENANCE, "types").alias("value"))
    good = json.loads(value.first().value)
    changes = [({}, []), ({"doi": 5}, ["doi"]), ({"extra": 1}, ["additional"]), ({"action": "update"}, ["original_required"]), ({"field": "nope"}, ["field"]), ({"enrichedValue": True}, ["enriched_type"]), ({"contributors": []}, ["contributors"]), ({"contributors": [{"name": "X", "contributorType": "Nobody"}]}, ["contributor_shape"]), ({"resources": [7]}, ["resource_shape"])]
    rows = spark.createDataFrame([(i, json.dumps(good | c)) for i, (c, _) in enumerate(changes)], "i int, value string")
    native = {r.i: r.e for r in rows.select("i", record_errors("value").alias("e")).collect()}
    full = {r.i: r.errors for r in validate_json(rows, JsonSchema(builtin_schema())).collect()}
    for i, (_, expected) in enumerate(changes):
        assert native[i] == expected
        assert bool(full[i]) == bool(expected)
    with pytest.raises(ConfigError, match="patternProperties"):
        JsonSchema({"patternProperties": {}})
