"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

OP9 = r"""
WITH urls AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), ranked AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY urls.page_id, url_row ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS nth
  FROM (SELECT *, row_number() OVER () AS url_row FROM urls) urls
  LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM ranked WHERE nth = 1
"""

OP6 = r"""
WITH numbered AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM documents
), lines AS (
  SELECT doc_id, n, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS nth
  FROM numbered
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key
), judged AS (
  SELECT keyed.doc_id, n, nth, line, coalesce(keyed.doc_id > first, false) AS dropped
  FROM keyed LEFT JOIN firsts USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id, n
"""

OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(rank - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS most FROM named
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
     - coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), settled AS (
  SELECT *, max(CASE WHEN level < most / weight THEN level END) OVER () AS settled FROM levels
), sources AS (
  SELECT source, rank, source_size, coalesce(least(most, settled * weight), most) AS target FROM settled
), queued AS (
  SELECT doc_id, size, source_size, target, rank,
         sum(size) OVER (PARTITION BY rank ORDER BY place, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)::BIGINT AS position
  FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source
), numbered AS (
  SELECT *, row_number() OVER () AS n FROM queued
), turns AS (
  SELECT n, size, rank, position + epoch * source_size AS place, (position + epoch * source_size)::DOUBLE / target AS finish
  FROM numbered, (VALUES (0), (1)) epochs(epoch) WHERE size > 0 AND target > 0
), served AS (
  SELECT n, size, sum(size) OVER (ORDER BY finish, rank, place ROWS UNBOUNDED PRECEDING) AS total FROM turns
), taken AS (
  SELECT n, sum(size)::BIGINT AS taken FROM served WHERE total <= (SELECT sum(target) FROM sources) GROUP BY n
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM numbered LEFT JOIN taken USING (n)
"""

OP10 = r"""
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, [floor(x::DOUBLE * 256)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), parts AS (
  SELECT n, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM usable
), products AS (
  SELECT q.n AS query, c.n AS other, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.n <> c.n
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, c.vec_id, other)::INTEGER AS rank, c.vec_id, score
FROM products JOIN usable q ON query = q.n JOIN usable c ON other = c.n QUALIFY rank <= 5
"""

OP11 = r"""
WITH RECURSIVE numbered AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
), usable AS MATERIALIZED (
  SELECT * FROM numbered
  WHERE label IS NOT NULL AND v IS NOT NULL AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN v IF x <> 0]) > 0
), links AS MATERIALIZED (
  SELECT a.n AS a, b.n AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.n <> b.n AND list_cosine_similarity(a.v, b.v) >= 0.98
), reach(n, m) AS (
  SELECT n, n FROM numbered
  UNION
  SELECT reach.n, links.b FROM reach JOIN links ON reach.m = links.a
), least AS (
  SELECT reach.n, min(other.vec_id) AS component_id FROM reach JOIN numbered other ON reach.m = other.n GROUP BY reach.n
), degrees AS (
  SELECT a AS n, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM numbered JOIN least USING (n) LEFT JOIN degrees USING (n)
"""

OP12 = r"""
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(x::DOUBLE * 256)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), parts AS (
  SELECT n, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM usable
), products AS (
  SELECT q.n AS anchor, c.n AS other, sum(q.x * c.x)::BIGINT AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.n <> c.n
  WHERE q.vec_id % 100 = 0 GROUP BY ALL
), scored AS (
  SELECT anchor, other, a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, score
  FROM products JOIN usable a ON anchor = a.n JOIN usable o ON other = o.n
), positives AS (
  SELECT anchor, other, anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY score DESC, vec_id, s.other)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor = s.anchor AND NOT s.same
WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {
    "op6_line_dedup": OP6,
    "op7_mixing": OP7,
    "op9_url_filters": OP9,
    "op10_exact_top_k": OP10,
    "op11_embedding_near_dedup": OP11,
    "op12_hard_negatives": OP12,
}
