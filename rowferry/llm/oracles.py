"""SQL for DuckDB that gives the results of the operators' queries, where SQL can express them."""

from __future__ import annotations

from .licenses import TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SOLID = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"


def _strings(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_PHRASES = ", ".join(f"('{t.label}', {_strings(t.words.split())})" for t in TEMPLATES if t.phrase)
_SETS = ", ".join(f"('{t.label}', {_strings(t.tokens)}, {t.need})" for t in TEMPLATES if not t.phrase)

LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
phrases(label, p) AS (VALUES {_PHRASES}), sets(label, toks, need) AS (VALUES {_SETS}),
places AS (
  SELECT r, label, i - 1 AS pos FROM (SELECT r, w, label, p, unnest(range(1, len(w) - len(p) + 2)) AS i FROM d, phrases)
  WHERE w[i:i + len(p) - 1] = p
),
blocks AS (SELECT r, w[s + 1:s + 64] AS x FROM (SELECT r, w, unnest(range(0, len(w), 32)) AS s FROM d)),
held AS (
  SELECT r, label, len(list_intersect(x, toks)) / len(toks) AS share FROM blocks, sets WHERE len(list_intersect(x, toks)) >= need
),
base AS (SELECT r, count(*) AS n, min(pos) AS a, max(pos) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM places GROUP BY r),
found AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS l, max(share) AS s
  FROM (SELECT r, label, share FROM held UNION ALL SELECT r, label, 1.0 FROM places) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word, coalesce(base.l, '') AS base_labels,
  coalesce(found.l, '') AS labels, CAST(coalesce(s, 0.0) AS DOUBLE) AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SOLID} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""



def _crc_char() -> str:
    """The checksum ``a`` after a character ``x``: eight steps, one for each bit."""
    step = "xor(a, x)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda v: xor(v >> 1, 3988292384 * (v & 1)))[1]"
    return step


PREFIX_TRIE = rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY i) AS own FROM t GROUP BY conv_id),
bits AS (
  SELECT conv_id, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, x: {_crc_char()}) AS crc FROM c
),
h AS (SELECT conv_id, CAST(xor(crc, 4294967295) % 9 AS INTEGER) AS h FROM bits),
v AS (
  SELECT c.conv_id, list_concat(coalesce(f.own, [])[1:h], c.own[h + 1:]) AS turns
  FROM c JOIN h USING (conv_id) LEFT JOIN c f ON f.conv_id = c.conv_id - c.conv_id % 5
),
p AS (SELECT conv_id, len(turns) AS n, d, md5(CAST(turns[1:d] AS VARCHAR)) AS k, CASE WHEN d > 0 THEN md5(CAST(turns[1:d - 1] AS VARCHAR)) END AS up,
    CASE WHEN d > 0 THEN strlen(turns[d].t) ELSE 0 END AS size
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM v)),
node AS (
  SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM p GROUP BY d, k
),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY d, up),
above(d, k, ad, ak) AS (
  SELECT d, k, d, k FROM node UNION ALL SELECT above.d, above.k, node.d - 1, node.up FROM above JOIN node ON node.d = above.ad AND node.k = above.ak WHERE node.d > 0
),
sums AS (
  SELECT ad AS d, ak AS k, sum(own) AS saved, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM above JOIN node USING (d, k) LEFT JOIN kids USING (d, k) GROUP BY ad, ak
)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN sums USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN node parent ON parent.d = node.d - 1 AND parent.k = node.up
"""

HARD_NEGATIVES = """
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 100 = 0
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""

NEAR_VECTORS = """
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN degrees USING (vec_id)
"""
