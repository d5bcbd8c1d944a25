"""DuckDB SQL that gives the operators' results by plainer means."""

# Lines by text instead of hash, grouped over all documents.
LINES = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.doc_id, pos, line, g.key IS NOT NULL AND k.doc_id <> g.top AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id"""

# Windows as joined words, met by equality; a hit covers the words of its window.
DECONTAM = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win FROM b WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bw),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dp AS (SELECT doc_id, ns.n, w, unnest(range(1, len(w) - ns.n + 2)) AS i FROM d, ns WHERE len(w) >= ns.n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM dp),
h AS (SELECT DISTINCT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) q GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) q GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id"""

# Every pair by cosine, then the reachable rows by recursion.
EMBEDDINGS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
u AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS r FROM v),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_dot_product(a.x, b.x) / (a.r * b.r) >= 0.95),
reach AS (SELECT vec_id AS n, vec_id AS r FROM v UNION SELECT e.b, reach.r FROM reach JOIN e ON reach.n = e.a),
c AS (SELECT n, min(r) AS root FROM reach GROUP BY n),
k AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT m.vec_id, coalesce(n_links, 0) AS n_links, coalesce(root, m.vec_id) AS component_id, m.vec_id = coalesce(root, m.vec_id) AS kept
FROM embeddings m LEFT JOIN c ON m.vec_id = c.n LEFT JOIN k ON m.vec_id = k.a"""

# Trees by recursion over levels; a document's fold and proof climb its source's tree, then the tree of the subroots.
# The CRC-32 of the id goes bit by bit: a byte is mixed in, then -1 stands for a shift.
MERKLE = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, '=' || source AS tag, lang, n_chars, text,
  list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END) AS crc FROM documents),
low AS (SELECT *, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claimed FROM d),
f AS (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM low),
leaf AS (SELECT r, doc_id, coalesce(tag, '') AS g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h, sha256(head || coalesce(strlen(claimed) || ':' || claimed, '-')) AS c FROM f),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM leaf),
lv AS (SELECT g, 0 AS k, p, n, h FROM placed
  UNION ALL SELECT g, k + 1, p // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY p)) FROM lv WHERE n > 1 GROUP BY g, k, p // 16, n),
run AS (SELECT g, k, p // 16 AS b, list(h ORDER BY p) AS hs FROM lv WHERE n > 1 GROUP BY g, k, p // 16),
up AS (SELECT r, g, 0 AS k, p, c AS h, '' AS proof FROM placed
  UNION ALL SELECT up.r, up.g, up.k + 1, up.p // 16, sha256(array_to_string(hs[1:p % 16], '') || up.h || array_to_string(hs[p % 16 + 2:], '')), up.proof || array_to_string(hs[1:p % 16], '') || array_to_string(hs[p % 16 + 2:], '')
  FROM up JOIN run ON up.g = run.g AND up.k = run.k AND up.p // 16 = run.b),
sub AS (SELECT g, h FROM lv WHERE n = 1),
heads AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM sub),
tlv AS (SELECT 0 AS k, p, n, h FROM heads
  UNION ALL SELECT k + 1, p // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY p)) FROM tlv WHERE n > 1 GROUP BY k, p // 16, n),
trun AS (SELECT k, p // 16 AS b, list(h ORDER BY p) AS hs FROM tlv WHERE n > 1 GROUP BY k, p // 16),
last AS (SELECT r, max(k) AS k FROM up GROUP BY r),
tup AS (SELECT up.r, 0 AS k, heads.p, up.h, up.proof FROM up JOIN last ON up.r = last.r AND up.k = last.k JOIN heads ON up.g = heads.g
  UNION ALL SELECT tup.r, tup.k + 1, tup.p // 16, sha256(array_to_string(hs[1:p % 16], '') || tup.h || array_to_string(hs[p % 16 + 2:], '')), tup.proof || array_to_string(hs[1:p % 16], '') || array_to_string(hs[p % 16 + 2:], '')
  FROM tup JOIN trun ON tup.k = trun.k AND tup.p // 16 = trun.b),
tlast AS (SELECT r, max(k) AS k FROM tup GROUP BY r),
root AS (SELECT h FROM tlv WHERE n = 1)
SELECT placed.doc_id, placed.h AS leaf, sub.h AS subroot, root.h AS root, sha256(tup.proof) AS proof_sha256, tup.h AS folded_root, tup.h = root.h AS verified
FROM placed JOIN tlast ON placed.r = tlast.r JOIN tup ON tup.r = tlast.r AND tup.k = tlast.k JOIN sub ON placed.g = sub.g, root"""

# Every anchor with every row, ranked by score.
NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: CAST(floor(256 * e::DOUBLE) AS BIGINT)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.x::DOUBLE[], b.x::DOUBLE[]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) <= 5"""
