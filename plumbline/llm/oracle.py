"""DuckDB SQL for those text queries that SQL can express."""

from __future__ import annotations

_SHINGLED = r"""
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [w]
    ELSE list_distinct([w[i:i+4] FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words),
"""

ORACLES: dict[str, str] = {
    "op3_superminhash_dedup": "WITH RECURSIVE "
    + _SHINGLED
    + """
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
flat AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 85 * (na + nb - shared)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sized
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lab AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sized JOIN lab USING (doc_id)
""",
    "op11_collision_vectors": """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS i, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (
  SELECT i, v, len(v) AS d FROM rows
  WHERE len(v) > 0 AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN v IF x <> 0]) > 0),
links AS (SELECT a.i AS a, b.i AS b FROM good a JOIN good b ON a.d = b.d AND a.i <> b.i WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT i AS a, i AS b FROM rows UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lab AS (SELECT r.a AS i, min(s.vec_id) AS component_id FROM reach r JOIN rows s ON r.b = s.i GROUP BY r.a),
deg AS (SELECT a AS i, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM rows JOIN lab USING (i) LEFT JOIN deg USING (i)
""",
    "op13_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
flat AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS all_n FROM flat GROUP BY ALL HAVING count(DISTINCT d) >= 30),
grp AS (SELECT DISTINCT lang, source FROM docs),
cnt AS (SELECT lang, source, term, count(*) AS n FROM flat SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n FROM grp LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
voc AS (SELECT lang, count(*)::HUGEINT AS v, sum(all_n)::HUGEINT AS n FROM kept GROUP BY lang),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.n + 5 * v.v) AS p,
    1 + 1000000000::HUGEINT * (k.all_n + 5) // (v.n + 5 * v.v) AS q
  FROM tot g JOIN voc v USING (lang) JOIN kept k USING (lang) LEFT JOIN cnt c USING (lang, source, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM dense WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
""",
}
