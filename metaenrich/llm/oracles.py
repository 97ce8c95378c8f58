"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

OP3 = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents)
), windows AS (
  SELECT doc_id, pos, word, CASE WHEN count(*) OVER span = 35 THEN string_agg(word, ' ') OVER span END AS k
  FROM words WINDOW span AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), twice AS (SELECT k FROM windows WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1),
marked AS (SELECT w.doc_id, w.pos, w.word, (t.k IS NOT NULL)::INT AS starts FROM windows w LEFT JOIN twice t ON w.k = t.k),
judged AS (
  SELECT doc_id, pos, word, max(starts) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM marked
), counted AS (
  SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_words, 0) AS n_words, coalesce(c.n_removed, 0) AS n_removed, sha256(coalesce(c.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id
"""

OP4 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split WHERE len(w) >= 5),
grams AS (
  SELECT doc_id, string_agg(word, ' ') OVER span AS s, count(*) OVER span AS n
  FROM words WINDOW span AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
), sets AS (
  SELECT DISTINCT doc_id, s FROM grams WHERE n = 5
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM split WHERE len(w) BETWEEN 1 AND 4
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
pairs AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, b.y FROM reach r JOIN pairs b ON r.other = b.x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) r ON r.doc_id = d.doc_id
"""

OP12 = """
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
grouped AS (SELECT *, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) AS place FROM lowered WINDOW w AS (PARTITION BY t))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM grouped
"""


def op11(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3:") -> str:
    """Plain Lloyd: every round compares every vector with every centroid and sums all vectors."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('{seed}' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT p.rid, any_value(p.vec_id) AS vec_id, any_value(p.v) AS v, min({{'d': list_sum(list_transform(list_zip(p.v, q.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': q.c}}) AS best
  FROM kept p, c{r} q GROUP BY p.rid)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  WITH sums AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i),
  moved AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sums GROUP BY c)
  SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN moved m ON m.c = o.c)""")
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, a.best.c::INT AS cluster, a.best.d AS distance, (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(q.v, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} q ON q.c = a.best.c"""
