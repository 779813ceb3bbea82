"""DuckDB SQL for the operators whose whole result SQL expresses, besides those beside their operators."""

from __future__ import annotations

from lexspark.llm.secrets import BASE, RULES


def _kind(rank: int, r) -> str:
    pattern = "'" + r.pattern.replace("'", "''") + "'"
    return f"SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(text, {pattern}) AS ms, regexp_extract_all(text, {pattern}, {r.group}) AS gs, string_split_regex(text, {pattern}) AS gaps FROM d WHERE regexp_matches(text, {pattern})"


_SPAN_ORDER = "',' ORDER BY s, rank"
OP7_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(_kind(k, r) for k, r in enumerate(RULES))}),
e AS (SELECT doc_id, rank, kind, least, ms, gs, gaps, unnest(range(1, len(ms) + 1)) AS i FROM m),
p AS (SELECT doc_id, rank, kind, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s, length(ms[i]) AS n FROM e WHERE length(gs[i]) >= least),
g AS (SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS b, count(*) FILTER (rank = 2) AS c,
  string_agg(kind || ':' || s || ':' || (s + n), {_SPAN_ORDER}) FILTER (rank < {len(BASE)}) AS base, string_agg(kind || ':' || s || ':' || (s + n), {_SPAN_ORDER}) AS spans FROM p GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN g USING (doc_id)
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP9_SQL = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark), b2 AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b2)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
