"""DuckDB SQL of the registered queries, computed from scalars rather than from the JSON that the engine parses."""

from __future__ import annotations

from ..operators.rules import Rules
from .views import SUFFIXES, large_references


def _q(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(_q, values)) + "]"


def build(rules: Rules, labels: tuple[str, ...], general: tuple[str | None, ...], other: str, files: tuple[dict, ...], provenance: str, nested: tuple[bool, ...]) -> dict[str, str]:
    typos = "MAP {" + ", ".join(f"{_q(a)}: {_q(b)}" for a, b in rules.typo_corrections.items()) + "}"
    clean = lambda t: rf"regexp_replace(lower({t}), '[-_.,;:!?()\[\]{{}}''\"/\\]', ' ', 'g')"
    words = lambda t: rf"list_filter(string_split_regex({t}, '\s+'), lambda w: w <> '')"
    norm = lambda t: f"array_to_string(list_transform({words(clean(t))}, lambda w: coalesce(map_extract({typos}, w)[1], w)), '')"
    refs = lambda values: f"refs AS (SELECT {norm('v')} AS r, v FROM (SELECT unnest({_list(values)}) AS v))"
    excluded = " OR ".join(f"(list_contains({_list(e.normalized)}, n1) AND list_contains({_list(e.matches)}, m))" for e in rules.redundancy_exclusions) or "false"

    def matched(source: str, values: tuple[str, ...] = rules.reference_values, excluded: str = excluded) -> str:
        """CTEs up to rated(t, matched, outcome) for the distinct texts of a query with a column t."""
        squeezed = r"regexp_replace(lower(t), '\s+', '', 'g')"
        return f"""{refs(values)},
        texts AS (SELECT DISTINCT t FROM ({source}) WHERE t IS NOT NULL),
        keyed AS (SELECT t, {norm('t')} AS n1, CASE WHEN len({words('t')}) > 1 THEN {norm(squeezed)} END AS n2 FROM texts),
        ratios AS (SELECT t, v, r, 1.0::DOUBLE - levenshtein(n1, r) / greatest(length(n1), length(r))::DOUBLE AS ratio FROM keyed, refs),
        near AS (SELECT t, v FROM (SELECT t, v, row_number() OVER (PARTITION BY t ORDER BY ratio DESC, r) AS i FROM ratios WHERE ratio > 0 AND ratio >= {rules.threshold}::DOUBLE) WHERE i = 1),
        found AS (SELECT k.t, k.n1, coalesce(a.v, b.v, n.v) AS m FROM keyed k LEFT JOIN refs a ON a.r = k.n1 LEFT JOIN refs b ON b.r = k.n2 LEFT JOIN near n ON n.t = k.t),
        outcomes AS (SELECT t, m, CASE WHEN m IS NULL THEN 'no_match' WHEN {excluded} THEN 'redundant' END AS outcome FROM found),
        rated AS (SELECT t, CASE WHEN outcome IS NULL THEN m END AS matched, outcome FROM outcomes)"""

    scope = [v for v in rules.target_scope if v is not None]
    in_scope = f"(general IS NULL AND {str(rules.allow_null).lower()} OR coalesce(general IN ({', '.join(map(_q, scope))}), false))"
    rec = f"""rec AS (
        SELECT o_orderkey AS k, o_orderkey % 19 <> 0 AS is_types, CASE WHEN o_orderkey % 11 <> 0 THEN '10.5555/' || o_orderkey END AS doi,
          CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 19 <> 0 THEN {_list(labels)}[o_orderkey % {len(labels)} + 1] END AS free,
          CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 19 <> 0 THEN {_list(general)}[o_orderkey % {len(general)} + 1] END AS general
        FROM orders WHERE o_orderkey % 17 <> 0)"""
    classified = f"""WITH {rec}, {matched("SELECT DISTINCT free AS t FROM rec WHERE free <> ''")},
        classified AS (SELECT rec.*, rated.matched, CASE WHEN NOT is_types THEN 'malformed_types' WHEN NOT {in_scope} THEN 'not_in_scope' WHEN coalesce(free, '') = '' THEN 'no_resource_type'
          WHEN outcome IS NOT NULL THEN outcome WHEN matched IS NOT DISTINCT FROM general THEN 'no_change' WHEN coalesce(doi, '') = '' THEN 'no_doi' END AS skip_reason
        FROM rec LEFT JOIN rated ON rated.t = rec.free)"""
    free_json = "CASE WHEN k % 13 = 0 THEN '7' ELSE '\"' || free || '\"' END"
    types = lambda value: f"""CASE WHEN k % 7 = 0 THEN '{{{other},"resourceType":' || {free_json} || {value('absent')} || '}}' ELSE '{{"resourceTypeGeneral":' || {value('present')} || ',{other},"resourceType":' || {free_json} || '}}' END"""
    original = types(lambda w: "''" if w == "absent" else "coalesce('\"' || general || '\"', 'null')")
    enriched = types(lambda w: "',\"resourceTypeGeneral\":\"' || matched || '\"'" if w == "absent" else "'\"' || matched || '\"'")
    parts = f"{classified} SELECT doi, 'update' AS action, {original} AS original, {enriched} AS enriched FROM classified WHERE skip_reason IS NULL"
    record = f"""'{{"doi":"' || doi || '",' || {_q(provenance)} || ',"action":"update","field":"types","originalValue":' || original || ',"enrichedValue":' || enriched || '}}'"""
    all_texts = f"SELECT DISTINCT t FROM (SELECT unnest([p_type, p_name]) AS t FROM part UNION ALL SELECT {_list(labels)}[o_orderkey % {len(labels)} + 1] FROM orders)"
    suffixed = f"SELECT DISTINCT {_list(labels)}[o_orderkey % {len(labels)} + 1] || ' ' || {_list(SUFFIXES)}[o_orderkey % 7 + 1] AS t FROM orders"
    camel = lambda t: rf"regexp_replace(regexp_replace({t}, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '([A-Z]+)([A-Z][a-z])', '\1 \2', 'g')"
    orgs = "orgs AS (SELECT s_suppkey AS s, 'https://ror.example/' || s_suppkey AS id FROM supplier)"
    spelt = "CASE WHEN c_custkey % 3 = 0 THEN 'Institut' ELSE 'Institute' END || ' of Topic ' || (c_custkey % 60) || ' Studies'"
    known = "'Inst ' || (c_custkey % 60)"
    college = "'College ' || (c_custkey % 7)"
    has_doi, free_known = "c_custkey % 11 <> 0", "c_custkey % 2 <> 0"
    resolved = """forms AS (SELECT id, 'instituteoftopic' || s || 'studies' AS n FROM orgs UNION ALL SELECT id, 'inst' || s FROM orgs),
        keyed AS (SELECT input, replace(lower(input), ' ', '') AS f FROM inputs),
        exact AS (SELECT input, min(id) AS id, 1.0::DOUBLE AS score FROM keyed JOIN forms ON f = n GROUP BY input),
        near AS (SELECT input, id, 1.0::DOUBLE - levenshtein(f, n) / greatest(length(f), length(n))::DOUBLE AS score FROM keyed, forms WHERE input NOT IN (SELECT input FROM exact)),
        best AS (SELECT input, id, score FROM (SELECT *, row_number() OVER (PARTITION BY input ORDER BY score DESC, id) AS i FROM near WHERE score >= 0.9::DOUBLE) WHERE i = 1),
        hits AS (SELECT * FROM exact UNION ALL SELECT * FROM best)"""
    asked = f"asked AS (SELECT {spelt} AS input FROM customer WHERE {has_doi} UNION ALL SELECT {college} FROM customer WHERE {has_doi} UNION ALL SELECT {known} FROM customer WHERE {has_doi} AND {free_known})"
    affiliations = f"WITH {orgs}, {asked}, inputs AS (SELECT DISTINCT input FROM asked), {resolved}"
    ids = """'{"name":"' || %s || '","affiliationIdentifier":"' || %s || '","affiliationIdentifierScheme":"ROR","schemeUri":"https://ror.org"}'"""
    college_text = """'{"name":"' || """ + college + """ || '","place":' || (c_custkey % 5) || '}'"""
    bare_known = """CASE WHEN c_custkey % 2 = 0 THEN '{"name":"' || """ + known + """ || '","affiliationIdentifier":"x"}' ELSE '{"name":"' || """ + known + """ || '"}' END"""
    made_spelt = f"CASE WHEN p.id IS NULL THEN '\"' || {spelt} || '\"' ELSE {ids % (spelt, 'p.id')} END"
    made_known = f"CASE WHEN q.id IS NULL THEN {bare_known} ELSE {ids % (known, 'q.id')} END"
    creator = lambda first, third: f"""'{{"name":"A' || c_custkey || '","affiliation":[' || {first} || ',' || {college_text} || ',' || {third} || ',' || {first} || ']}}'"""
    raw_spelt = f"'\"' || {spelt} || '\"'"
    affiliation_parts = f"""{affiliations} SELECT '10.1/' || c_custkey AS doi, 'updateChild' AS action, {creator(raw_spelt, bare_known)} AS original, {creator(made_spelt, made_known)} AS enriched
        FROM customer LEFT JOIN hits p ON p.input = {spelt} LEFT JOIN hits q ON q.input = {known} AND {free_known} WHERE {has_doi} AND (p.id IS NOT NULL OR q.id IS NOT NULL)"""
    reference = lambda number, kind: f"""'{{"funderName":"' || {known} || '","funderIdentifier":"' || {number} || '","funderIdentifierType":"{kind}"}}'"""
    funder_parts = f"""WITH {orgs}, inputs AS (SELECT DISTINCT {known} AS input FROM customer WHERE {has_doi} AND c_custkey % 4 <> 0 UNION SELECT 'Nobody ' || (c_custkey % 3) FROM customer WHERE {has_doi} AND c_custkey % 4 = 0), {resolved},
        found AS (SELECT c_custkey, coalesce(w.id, q.id) AS id FROM customer LEFT JOIN orgs w ON w.s = c_custkey % 90 LEFT JOIN hits q ON q.input = {known} WHERE {has_doi} AND c_custkey % 4 <> 0)
        SELECT '10.1/' || c_custkey AS doi, 'updateChild' AS action, {reference("'https://doi.org/10.13039/10000' || (c_custkey % 90)", 'Crossref Funder ID')} AS original, {reference('id', 'ROR')} AS enriched FROM found WHERE id IS NOT NULL"""
    entries = [
        (i, kind, pos, e.get(name), e.get(label))
        for i, data in enumerate(files)
        for kind, key, name, label in (("contributor", "contributors", "name", "contributorType"), ("resource", "resources", "relatedIdentifier", "relationType"))
        for pos, e in enumerate(data.get(key, []))
    ]
    flattened = "SELECT * FROM (VALUES " + ", ".join(f"({i}, {_q(kind)}, {pos}, {_q(name)}, {_q(label)})" for i, kind, pos, name, label in entries) + ") AS v(case_no, kind, pos, name, type)"
    validation = """WITH c AS (SELECT c_custkey AS k, ['update', 'updateChild', 'insert', 'deleteChild', 'replace'][c_custkey % 5 + 1] AS action, c_custkey % 6 AS o, c_custkey % 7 = 0 AS bare FROM customer)
        SELECT k, array_to_string(list_sort(list_filter([CASE WHEN action = 'replace' THEN 'action' END, CASE WHEN k % 3 <> 0 THEN 'field' END, CASE WHEN o IN (4, 5) THEN 'original_type' END,
          CASE WHEN bare AND action IN ('update', 'updateChild', 'insert') THEN 'enriched_required' END], lambda e: e IS NOT NULL)), ',') AS errors FROM c"""
    return {
        "strict_parse_counts": "SELECT count(*) FILTER (WHERE o_orderkey % 17 <> 0) AS records_scanned, count(*) FILTER (WHERE o_orderkey % 17 = 0) AS lines_malformed FROM orders",
        "typed_string_paths": f"WITH {rec} SELECT doi, free, general, is_types FROM rec",
        "event_props_types": """SELECT event_id, json_valid(props) AS ok, json_type(props) = 'OBJECT' AS is_object, CASE WHEN json_type(props, '$.k') = 'VARCHAR' THEN props ->> '$.k' END AS k_text,
            CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') THEN (props ->> '$.k')::BIGINT END AS k_number FROM events""",
        "smart_normalize": f"SELECT t, {norm('t')} AS n FROM ({all_texts})",
        "camel_tokens": f"SELECT t, array_to_string({words(camel('t'))}, '|') AS tokens FROM ({all_texts})",
        "camel_concat": f"SELECT t, n, CASE WHEN n IS NOT NULL THEN array_to_string({words(clean('n'))}, '') = plain END AS same FROM (SELECT t, CASE WHEN len({words(camel('t'))}) > 1 THEN {norm("array_to_string(" + words(camel('t')) + ", '')")} END AS n, array_to_string({words(clean('t'))}, '') AS plain FROM ({all_texts}))",
        "levenshtein_ratio": f"SELECT t, ref, round(1.0::DOUBLE - levenshtein(lower(t), lower(ref)) / greatest(length(t), length(ref))::DOUBLE, 6) AS ratio FROM ({all_texts}), (SELECT unnest({_list(rules.reference_values)}) AS ref)",
        "fuzzy_match": f"WITH {matched(all_texts)} SELECT t, matched, outcome FROM rated",
        "part_type_match": f"WITH {matched('SELECT p_type AS t FROM part')} SELECT p_partkey, p_type, matched, outcome FROM part LEFT JOIN rated ON t = p_type",
        "large_vocabulary_match": f"WITH {matched(suffixed, large_references(rules), 'false')} SELECT t, matched, outcome FROM rated",
        "redundancy_filter": f"WITH {matched(all_texts)} SELECT t FROM rated WHERE outcome = 'redundant'",
        "scope_filter": f"WITH {rec} SELECT general, count(*) AS n, bool_and({in_scope}) AS in_scope FROM rec GROUP BY general",
        "skip_reason_counts": f"{classified} SELECT coalesce(skip_reason, 'emitted') AS reason, count(*) AS n FROM classified GROUP BY 1",
        "reclassify_emitted": f"{classified} SELECT doi, free, general, matched FROM classified WHERE skip_reason IS NULL",
        "enriched_types_json": parts,
        "enrichment_records": f"SELECT doi, {record} AS value FROM ({parts})",
        "record_validation": validation,
        "provenance_flatten": f"""WITH c AS (SELECT s_suppkey AS k, s_suppkey % 9 AS kind FROM supplier), entries AS ({flattened})
            SELECT k, e.kind, e.pos, replace(e.name, 'Example Organisation', 'Organisation ' || k) AS name, e.type FROM c JOIN entries e ON e.case_no = c.kind""",
        "nested_validation": f"""SELECT c_custkey AS k, concat_ws(',', CASE WHEN NOT {"[" + ", ".join(str(ok).lower() for ok in nested) + "]"}[c_custkey % {len(nested)} + 1] THEN 'contributor_shape' END,
            CASE WHEN c_custkey % 5 >= 2 THEN 'resource_shape' END) AS errors FROM customer""",
        "schema_validation": f"SELECT k, errors = '' AS valid FROM ({validation})",
        "provenance_problems": """SELECT s_suppkey AS k, pos, problem FROM supplier JOIN (VALUES (1, 0, 'missing required contributor: Somebody Else / Organizational / Producer'),
            (2, 0, 'missing required contributor: any name / Organizational / Producer'), (3, 0, 'contributors[1]: unknown contributorType "Nobody"'),
            (3, 1, 'contributors[1]: unknown nameType "Robot"'), (4, 0, 'resources[2]: unknown relationType "Wrong"'), (4, 1, 'resources[2]: unknown relatedIdentifierType "XYZ"'),
            (4, 2, 'resources[2]: unknown resourceTypeGeneral "Thing"'), (5, 0, 'contributors must not be empty'), (5, 1, 'resources must not be empty'),
            (5, 2, 'missing required contributor: any name / Organizational / Producer'), (5, 3, 'missing required resource: IsDocumentedBy / Project'), (5, 4, 'missing required resource: IsDerivedFrom / Dataset'),
            (6, 0, 'missing required resource: IsDocumentedBy / Project'), (7, 0, 'refused: contributors[0]: unknown field `nam`'), (8, 0, 'refused: missing field `resources`')) AS v(kind, pos, problem) ON kind = s_suppkey % 9""",
        "registry_names": "SELECT 'https://ror.example/' || s_suppkey AS id, 'Institute of Topic ' || s_suppkey || ' Studies' AS name, 2 AS n_names FROM supplier",
        "crosswalk_join": f"WITH {orgs} SELECT '10000' || s AS external_id, id FROM orgs",
        "distinct_inputs": f"WITH {asked} SELECT DISTINCT input FROM asked",
        "registry_matches": f"{affiliations} SELECT input, id, 'Institute of Topic ' || s || ' Studies' AS name, round(score, 6) AS score FROM hits JOIN orgs USING (id)",
        "unmatched_inputs": f"{affiliations} SELECT input FROM inputs WHERE input NOT IN (SELECT input FROM hits)",
        "affiliation_skips": f"""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN {has_doi} THEN 'asked' ELSE 'no_doi' END AS reason FROM customer, range(3) UNION ALL SELECT 'no_affiliation' FROM customer
            UNION ALL SELECT CASE WHEN NOT ({free_known}) THEN 'has_identifier' WHEN {has_doi} THEN 'asked' ELSE 'no_doi' END FROM customer) GROUP BY reason""",
        "reconcile_join": affiliation_parts,
        "funder_parts": f"SELECT DISTINCT * FROM ({funder_parts})",
        "staged_run": f"""WITH n AS (SELECT count(*) AS n FROM ({affiliation_parts})) SELECT step, due, CASE WHEN made THEN n ELSE 0 END AS parts, complete FROM n, (VALUES ('first', 'extract,query,reconcile', true, true),
            ('second', '', false, true), ('reopened', 'query,reconcile', true, true), ('only extract', '', false, true), ('only reconcile', '', true, true), ('from scratch', 'extract,query,reconcile', true, true)) AS v(step, due, made, complete)""",
        "corpus_run": f"""{classified}, c AS (SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 17 <> 0) AS ok, (SELECT count(*) FROM orders WHERE o_orderkey % 17 = 0) AS bad, count(*) FILTER (WHERE skip_reason IS NULL) AS e, count(skip_reason) AS s FROM classified)
            SELECT 'corpus' AS name, 3 AS files_processed, 1 AS files_failed, ok AS records_scanned, bad AS lines_malformed, e AS emitted, e AS written, 0::BIGINT AS invalid, s AS skipped, e AS lines_out FROM c
            UNION ALL SELECT 'empty', 0, 0, 0, 0, 0, 0, 0, 0, 0""",
        "stage_plan": """SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 2 <> 0 THEN 'extract,query,reconcile' WHEN c_custkey % 3 <> 0 THEN 'query,reconcile'
            WHEN c_custkey % 5 <> 0 THEN 'reconcile' ELSE '' END AS stages FROM customer""",
        "file_verdicts": "SELECT (o_orderkey % 5)::INT AS part, o_orderkey % 5 < 3 AS whole, CASE WHEN o_orderkey % 5 < 3 THEN count(*) END AS lines FROM orders GROUP BY o_orderkey % 5",
        "similar_names": f"""WITH {orgs}, spelt AS (SELECT 'Institute of Topic ' || (c_custkey % 90) || ' Studies' AS name, c_custkey % 20 + 1 AS cut, CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE '' END AS wrong FROM customer),
            inputs AS (SELECT DISTINCT left(name, cut) || wrong || substr(name, cut + 2) AS input FROM spelt), {resolved} SELECT input, id, round(score, 6) AS score FROM hits""",
        "run_counters": f"""{classified} SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 17 <> 0) AS records_scanned, (SELECT count(*) FROM orders WHERE o_orderkey % 17 = 0) AS lines_malformed,
            count(*) FILTER (WHERE skip_reason IS NULL) AS emitted, count(skip_reason) AS skipped FROM classified""",
    }
