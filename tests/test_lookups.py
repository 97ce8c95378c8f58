import json
import random
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from metaenrich.cli import main, parser
from metaenrich.functions import records as R
from metaenrich.operators.lookup import LookupConfig, RegistryResolver, ServiceResolver
from metaenrich.operators.method import EnrichmentMethod
from metaenrich.operators.organisations import Affiliations, Funders
from metaenrich.plans.catalogue import PROVENANCE
from metaenrich.plans.runner import RunOptions, run
from metaenrich.plans.staged import Stage, WorkDir, remaining, run_stages, stages_to_run
from metaenrich.plans.views import RULES_FILE
from metaenrich.sources.corpus import configure, parse
from metaenrich.sources.registry import Objects, read_registry
from metaenrich.streaming.stream import enrich_stream
from tests.test_records import CONFIGS, golden_lines, write_corpus

ORGS = [
    {"id": "https://ror.org/1", "names": [{"value": "Uni A", "types": ["alias"]}, {"value": "University of A", "types": ["ror_display"]}], "external_ids": [{"type": "fundref", "all": ["100000001"], "preferred": "100000001"}]},
    {"id": "https://ror.org/2", "names": [{"value": "Institute of Bees", "types": ["ror_display"]}], "external_ids": []},
]
RECORDS = [
    {"id": "10.1/a", "attributes": {"creators": [{"name": "X", "affiliation": ["Uni A", {"name": "Institute of Beess"}]}, {"name": "Y", "affiliation": []}], "fundingReferences": [{"funderName": "Unknown", "funderIdentifier": "https://doi.org/10.13039/100000001", "funderIdentifierType": "Crossref Funder ID"}]}},
    {"id": "10.1/b", "attributes": {"creators": [{"name": "Z", "affiliation": [{"name": "Uni A", "affiliationIdentifier": "x"}]}], "fundingReferences": [{"funderName": "institute of bees"}, {"funderName": "Nobody"}]}},
    {"id": "10.1/c"},
]


@pytest.fixture(scope="module")
def registry(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("registry") / "orgs.json"
    path.write_text(json.dumps(ORGS))
    return str(path)


def records(spark, method):
    configure(spark)
    return method.prepare(parse(spark.createDataFrame([(json.dumps(r),) for r in RECORDS], "value string"))).where("ok")


def test_stage_plan():
    done = lambda *names: {s: s.value in names for s in Stage}
    assert remaining(done(), False) == list(Stage)
    assert remaining(done("extract"), False) == [Stage.QUERY, Stage.RECONCILE]
    assert remaining(done("extract"), True) == list(Stage)
    assert remaining(done("query", "reconcile"), False) == list(Stage)
    assert remaining(done("extract", "query", "reconcile"), False) == []


def test_affiliations_staged(spark, tmp_path, registry):
    orgs = read_registry(spark, registry)
    method, work = Affiliations(RegistryResolver(orgs), orgs), WorkDir(spark, str(tmp_path / "work"))
    parts = run_stages(method, records(spark, method), work).collect()
    assert [p.doi for p in parts] == ["10.1/a"]
    made = json.loads(parts[0].enriched)
    assert made["name"] == "X" and [(a["name"], a["affiliationIdentifier"]) for a in made["affiliation"]] == [("Uni A", "https://ror.org/1"), ("Institute of Beess", "https://ror.org/2")]
    assert stages_to_run(work, False) == [] and run_stages(method, records(spark, method), work) is None
    work.unmark(Stage.QUERY)
    assert stages_to_run(work, False) == [Stage.QUERY, Stage.RECONCILE]
    assert run_stages(method, records(spark, method), work, only=Stage.RECONCILE).count() == 1


def test_affiliations_lose_nothing(spark, registry):
    """Unmatched entries, those with an identifier, order, repeats and other keys stay; equal creators are told apart."""
    listed = ["Uni A", "Unknown College", {"name": "B", "affiliationIdentifier": "x"}, {"name": "uni a", "note": [1, {"z": None}]}, "Uni A", 7, None]
    rows = [{"id": "10.1/a", "attributes": {"creators": [{"name": "X", "affiliation": listed, "orcid": "1"}, {"name": "X", "affiliation": listed, "orcid": "1"}, {"name": "Y", "affiliation": "no list"}]}}] * 2
    orgs = read_registry(spark, registry)
    method = Affiliations(RegistryResolver(orgs), orgs)
    configure(spark)
    extracted = method.extract(method.prepare(parse(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))).where("ok"))
    parts = method.map_back(extracted, method.lookup(method.inputs(extracted))).collect()
    assert len(parts) == 4 and len({p.enriched for p in parts}) == 1
    before, after = json.loads(parts[0].original), json.loads(parts[0].enriched)
    extra = {"affiliationIdentifier": "https://ror.org/1", "affiliationIdentifierScheme": "ROR", "schemeUri": "https://ror.org"}
    assert before == {"name": "X", "affiliation": listed, "orcid": "1"}
    assert after == before | {"affiliation": [{"name": "Uni A"} | extra, listed[1], listed[2], listed[3] | extra, {"name": "Uni A"} | extra, 7, None]}


@pytest.mark.parametrize("threshold", [0.9, 0.8, 0.66, 0.45, 1.0])
def test_similar_names_equal_brute_force(spark, threshold):
    """No similar name is missed, wherever the edits are; ties go to the smaller identifier."""
    rng = random.Random(3)
    names = ["University of Alpha", "Universities of Alpha", "Beta", "Institute for Very Long Names in the Northern Provinces", *("".join(rng.choices("abc", k=rng.randrange(1, 30))) for _ in range(60))]

    def damaged(text):
        chars = list(text)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(chars) + 1)
            chars[at : at + rng.randrange(2)] = rng.choice(["", "x", "a"])
        return "".join(chars)

    inputs = {damaged(n) for n in names for _ in range(4)} | {"Univrsity of Alpha", "niversity of Alpha", "x" * 4000, ""}
    orgs = spark.createDataFrame([(f"id{i:03}", [(n,)]) for i, n in enumerate(names)], "id string, names array<struct<value string>>")
    got = {r.input: (r.id, round(r.score, 9)) for r in RegistryResolver(orgs, threshold).resolve(spark.createDataFrame([(x,) for x in inputs], "input string")).collect()}
    form = lambda t: "".join(t.lower().split())

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    expected = {}
    for x in inputs:
        f = form(x)
        if not f or len(f) > 1000:
            continue
        best = min((-(1 - distance(f, form(n)) / max(len(f), len(form(n)))), f"id{i:03}") for i, n in enumerate(names))
        if -best[0] >= threshold:
            expected[x] = (best[1], round(-best[0], 9))
    assert got == expected and (threshold == 1.0 or got["Univrsity of Alpha"][0] == "id000" == got["niversity of Alpha"][0])


def organisations_of(spark, names):
    return spark.createDataFrame([(f"id{i:05}", [(n,)]) for i, n in enumerate(names)], "id string, names array<struct<value string>>")


def test_a_stored_index_is_read_again_and_a_changed_registry_rebuilds_it(spark, tmp_path):
    asked = spark.createDataFrame([("University of Alphaa",)], "input string")
    path = str(tmp_path / "index")
    resolve = lambda names, threshold=0.9: [tuple(r)[:2] for r in RegistryResolver(organisations_of(spark, names), threshold, path).resolve(asked).collect()]
    written = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    assert resolve(["Beta", "University of Alpha"]) == [("University of Alphaa", "id00001")]
    first = written()
    assert first and resolve(["Beta", "University of Alpha"]) == [("University of Alphaa", "id00001")] and written() == first
    assert resolve(["University of Alpha", "Beta"]) == [("University of Alphaa", "id00000")] and set(written()) != set(first)
    (tmp_path / "index" / "settings.json").unlink()  # a build that was broken off
    assert resolve(["University of Alpha", "Beta"]) == [("University of Alphaa", "id00000")]
    assert resolve(["University of Alpha", "Beta"], 0.99) == []


def test_keys_grow_with_length_and_no_key_holds_more_than_its_share(spark, tmp_path):
    rng = random.Random(4)
    names = ["".join(rng.choices("abcdefghijklmnop", k=n)) for n in (20, 40, 80, 160, 320)] + [f"{i:012b}".replace("0", "a").replace("1", "b") for i in range(3000)]
    index = RegistryResolver(organisations_of(spark, names), 0.9, str(tmp_path / "index")).index()
    per = {len(r.name): r["count"] for r in index.entries().groupBy("name").count().collect() if len(r.name) > 12}
    assert len(per) == 5 and all(n / 10 < k <= index.settings.q * n / 8 + 1 for n, k in per.items())
    shares = index.entries().groupBy("gram", "block").count()
    assert index.blocks().count() > 0 and shares.agg(F.max("count")).first()[0] < 1300 < shares.groupBy("gram").agg(F.sum("count")).agg(F.max("sum(count)")).first()[0]
    asked = spark.createDataFrame([("ab" * 5 + "aab",), ("b" + "ab" * 5,), ("c" * 12,)], "input string")
    found = {r.input: r.score for r in RegistryResolver(organisations_of(spark, names), 0.9, str(tmp_path / "index")).resolve(asked).collect()}
    assert found == {"ab" * 5 + "aab": pytest.approx(12 / 13), "b" + "ab" * 5: pytest.approx(11 / 12)}


def test_objects_of_a_dump_are_found_wherever_it_is_cut():
    rng = random.Random(5)
    objects = [{"id": f"x{i}", "names": [{"value": rng.choice(['a}b', 'q"{', "\\", "[,]", "é\\\"}"])}], "n": [[{}], {"m": {"k": "}"}}]} for i in range(30)]
    for text in (json.dumps(objects), json.dumps(objects, indent=1), "\n".join(map(json.dumps, objects)), "[null, 7, " + ",".join(map(json.dumps, objects)) + ', "x{", [{"in": "a list"}]]'):
        whole, scanner = text.encode(), Objects()
        assert list(map(json.loads, scanner.feed(whole))) == objects and not scanner.inside
        scanner = Objects()
        pieces = whole.split(b"}")  # as Spark cuts it; an escape is never cut
        assert [json.loads(o) for i, p in enumerate(pieces) for o in scanner.feed(b"}" * (i > 0) + p)] == objects


def test_a_dump_in_one_line_is_dealt_to_several_tasks(spark, tmp_path):
    (tmp_path / "orgs.json").write_text(json.dumps([{"id": f"o{i}", "names": [{"value": "x}" * (i % 7), "types": ["ror_display"]}]} for i in range(500)] + [{"names": []}, None]))
    found = read_registry(spark, str(tmp_path / "orgs.json"))
    rows = found.withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.id for r in rows) == sorted(f"o{i}" for i in range(500)) and len({r.task for r in rows}) > 1
    assert {r.id: r.name for r in rows}["o6"] == "x}" * 6


def test_funders_crosswalk_then_name(spark, registry):
    orgs = read_registry(spark, registry)
    method = Funders(RegistryResolver(orgs), orgs)
    extracted = method.extract(records(spark, method))
    parts = method.map_back(extracted, method.lookup(method.inputs(extracted))).collect()
    assert {(p.doi, json.loads(p.enriched)["funderIdentifier"]) for p in parts} == {("10.1/a", "https://ror.org/1"), ("10.1/b", "https://ror.org/2")}


def test_match_service(spark, registry):
    """Distinct inputs reach the service in batches; what it doesn't match stays out."""
    asked = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, body["task"], len(body["inputs"])))
            answer = json.dumps([{"input": x, "id": "https://ror.org/1", "score": 0.9} if x == "Uni A" else {"input": x, "id": None} for x in body["inputs"]]).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(answer)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        config = LookupConfig(f"http://127.0.0.1:{server.server_port}", batch_size=2, concurrency=1)
        inputs = spark.createDataFrame([(x,) for x in ("Uni A", "b", "c")], "input string")
        got = ServiceResolver(config, "affiliation").resolve(inputs).collect()
    finally:
        server.shutdown()
    assert [(r.input, r.id, r.score) for r in got] == [("Uni A", "https://ror.org/1", 0.9)]
    assert sorted(asked) == [("/match", "affiliation", 1), ("/match", "affiliation", 2)]


class Flaky:
    """A match service that counts what it is asked and fails as it is told."""

    def __init__(self, fails):
        self.answered, self.calls, self.fails = [], 0, fails
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):
                inputs = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["inputs"]
                outer.calls += 1
                if outer.fails(outer.calls, inputs):
                    self.send_response(503)
                    self.end_headers()
                    return
                outer.answered += inputs
                self.send_response(200)
                self.end_headers()
                self.wfile.write(json.dumps([{"input": x, "id": f"id-{x}", "score": 0.5} for x in inputs if x[-1] in "02468"]).encode())

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()


def ask(spark, service, path, n, url=None):
    config = LookupConfig(url or service.url, batch_size=5, concurrency=2, attempts=3, pause=0.01)
    inputs = spark.createDataFrame([(f"n{i}",) for i in range(n)] + [("n0",), (None,)], "input string")
    resolver = ServiceResolver(config, "affiliation", path)
    resolver.WAVE = 2
    return sorted(tuple(r) for r in resolver.resolve(inputs).collect()), resolver.ledger(spark)


def test_a_service_that_fails_every_third_call_is_asked_no_answered_input_again(spark, tmp_path):
    service, expected = Flaky(lambda call, _: call % 3 == 0), sorted((f"n{i}", f"id-n{i}", 0.5) for i in range(0, 60, 2))
    got, ledger = ask(spark, service, str(tmp_path / "ledger"), 60)
    assert got == expected and sorted(service.answered) == sorted({f"n{i}" for i in range(60)}) and ledger.failed().count() == 0
    calls = service.calls
    assert ask(spark, service, str(tmp_path / "ledger"), 60)[0] == expected and service.calls == calls  # nothing is open
    got, _ = ask(spark, service, str(tmp_path / "ledger"), 64)
    assert len(got) == 32 and len(service.answered) == 64
    service.server.shutdown()


def test_inputs_that_a_service_fails_for_are_set_aside(spark, tmp_path):
    service = Flaky(lambda _, inputs: bool({"n7", "n8"} & set(inputs)))
    got, ledger = ask(spark, service, str(tmp_path / "ledger"), 30)
    assert [x for x, _, _ in got] == sorted(f"n{i}" for i in range(0, 30, 2) if i != 8)
    assert {r.input for r in ledger.failed().collect()} == {"n7", "n8"} and len(service.answered) == len(set(service.answered)) == 28
    service.fails = lambda *_: False
    got, ledger = ask(spark, service, str(tmp_path / "ledger"), 30)
    assert len(got) == 15 and ledger.failed().count() == 0 and len(service.answered) == 30
    service.server.shutdown()
    service.server.server_close()
    got, ledger = ask(spark, service, str(tmp_path / "ledger"), 33)  # nobody listens any more
    assert len(got) == 15 and {r.input for r in ledger.failed().collect()} == {"n30", "n31", "n32"}


def test_a_broken_off_wave_is_not_read(spark, tmp_path):
    service = Flaky(lambda *_: False)
    ask(spark, service, str(tmp_path / "ledger"), 50)
    for marker in list((tmp_path / "ledger").glob("*/_SUCCESS"))[:1]:
        marker.unlink()
    got, ledger = ask(spark, service, str(tmp_path / "ledger"), 50)
    assert len(got) == 25 and 50 < len(service.answered) < 100 and ledger.rows().count() == 50
    service.server.shutdown()


def test_stages_are_tied_to_their_inputs(spark, tmp_path, registry):
    orgs, work = read_registry(spark, registry), WorkDir(spark, str(tmp_path / "work"))
    write_corpus(tmp_path / "in", [json.dumps(r) for r in RECORDS])
    options = RunOptions(str(tmp_path / "in"), str(tmp_path / "out"))
    emitted = lambda method: run(spark, method, options, PROVENANCE, work=work).emitted
    method = Affiliations(RegistryResolver(orgs), orgs)
    assert emitted(method) == 1 and emitted(method) == 0  # the second run finds all stages done
    write_corpus(tmp_path / "in", [json.dumps(RECORDS[0] | {"id": "10.1/new"})], "part_0002")
    assert emitted(method) == 2  # a new file
    assert emitted(Affiliations(RegistryResolver(orgs, 0.95), orgs)) == 2  # another threshold
    assert emitted(Affiliations(RegistryResolver(orgs.where("id like '%1'"), 0.95), orgs.where("id like '%1'"))) == 2  # another registry
    assert work.is_complete(Stage.EXTRACT) and not work.is_complete(Stage.EXTRACT, "another state")


class Tagger(EnrichmentMethod):
    """Another method on the same runner: every record with a doi becomes a Dataset."""

    field = "types"

    def extract(self, records):
        types = F.try_variant_get("record", "$.attributes.types", "variant")
        free = R.text_at(F.col("record"), "$.attributes.types.resourceType")
        reason = F.when(free.isNull(), "no_resource_type").when(R.text_at(F.col("record"), "$.id").isNull(), "no_doi")
        return records.select(R.text_at(F.col("record"), "$.id").alias("doi"), F.to_json(types).alias("types"), reason.alias("skip_reason"))

    def map_back(self, extracted, lookups):
        return extracted.where("skip_reason is null").select("doi", F.lit("update").alias("action"), F.col("types").alias("original"), F.lit('{"resourceTypeGeneral":"Dataset"}').alias("enriched"))


def test_another_method(spark, tmp_path):
    line = lambda i, types: json.dumps({"id": f"10.x/{i}", "attributes": {"types": types}})
    write_corpus(tmp_path / "in" / "updated_2024-01", [line(1, {"resourceType": "a"}), line(2, {}), "", line(3, {"resourceType": "b"}), "{not json"])
    stats = run(spark, Tagger(), RunOptions(str(tmp_path / "in"), str(tmp_path / "out")), PROVENANCE)
    assert (stats.files_processed, stats.records_scanned, stats.lines_malformed, stats.emitted, stats.skipped) == (1, 3, 1, 2, {"no_resource_type": 1})
    assert not (tmp_path / "out.tmp").exists()


def test_cli_arguments():
    shared = ["-i", "in", "-o", "out", "--provenance", "p.yaml"]
    args = parser().parse_args(["affiliations", *shared, "--ror-file", "r.json", "query"])
    assert (args.stage, args.ror_batch_size, args.ror_concurrency, args.threads, args.log_level) == ("query", 50, 50, 0, "info")
    for bad in (["resource-type-general", *shared], ["resource-type-general", *shared, "--rules", "r", "--ror-file", "x"], ["resource-type-general", *shared, "--rules", "r", "--schema", "s", "--no-validate"], ["funders", *shared], []):
        with pytest.raises(SystemExit):
            parser().parse_args(bad)


def test_cli_runs_and_reports_errors(spark, tmp_path, registry, capsys):
    write_corpus(tmp_path / "in", golden_lines())
    base = ["-i", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--provenance", str(CONFIGS / "provenance.yaml")]
    assert main(["resource-type-general", *base, "--rules", str(RULES_FILE)]) == 0
    assert spark.read.text(str(tmp_path / "out")).count() == 7
    assert main(["resource-type-general", *base, "--rules", str(tmp_path / "none.yaml")]) == 1
    assert main(["resource-type-general", *base, "--rules", str(RULES_FILE), "--organization", "Somebody"]) == 1
    assert "Somebody" in capsys.readouterr().err
    for text in ("organization: Another\n", "{}\n", "organization: 5\n", "["):
        (tmp_path / "settings.yaml").write_text(text)
        assert main(["resource-type-general", *base, "--rules", str(RULES_FILE), "--settings", str(tmp_path / "settings.yaml")]) == 1
    (tmp_path / "settings.yaml").write_text("organization: null\n")
    assert main(["resource-type-general", *base, "--rules", str(RULES_FILE), "--settings", str(tmp_path / "settings.yaml")]) == 0
    write_corpus(tmp_path / "in2", [json.dumps(r) for r in RECORDS])
    assert main(["affiliations", "-i", str(tmp_path / "in2"), "-o", str(tmp_path / "aff"), "--provenance", str(CONFIGS / "provenance.yaml"), "--ror-file", registry]) == 0
    assert spark.read.text(str(tmp_path / "aff")).count() == 1


def test_stream(spark, tmp_path):
    from metaenrich.operators.resource_type import ResourceTypeGeneral
    from metaenrich.plans.views import shipped_rules

    start = lambda: enrich_stream(spark, ResourceTypeGeneral(shipped_rules()), str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), PROVENANCE).awaitTermination(120)
    write_corpus(tmp_path / "in", golden_lines()[:6])
    start()
    write_corpus(tmp_path / "in", golden_lines()[6:], "part_0002")
    start()
    assert spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "out")).count() == 7
