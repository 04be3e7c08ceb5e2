"""DuckDB SQL for the queries that SQL can express, over whole tables."""

NGRAM_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l UNION SELECT doc_id, doc_id FROM documents),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""

EXACT_DEDUP = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY t)
SELECT t.doc_id, g.keep_id, g.n::BIGINT AS group_size, t.doc_id = g.keep_id AS kept, sha256(t.t) AS text_sha256
FROM t JOIN g ON g.t = t.t
"""

# base32 of a SHA-1: its 40 hex digits are 8 runs of 20 bits, four letters each
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * run + 1}, 5))::BIGINT >> {shift}) & 31)::INT, 1)"
    for run in range(8) for shift in (15, 10, 5, 0))

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT t, min(page_id) AS first FROM p GROUP BY t)
SELECT p.page_id, strlen(p.t)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN p.page_id = g.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> g.first THEN g.first END AS refers_to
FROM p JOIN g ON g.t = p.t
"""

# the CRC-32 of a decimal number, digit by digit
_CRC32 = """list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"""

PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id AS c, conv_id - conv_id % 100 AS base, xor({_CRC32}, 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.c, t.i, t.r, t.x FROM c JOIN t ON t.conv_id = c.base AND t.i < c.h
      UNION ALL SELECT c.c, t.i, t.r, t.x FROM c JOIN t ON t.conv_id = c.c AND t.i >= c.h),
s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS d, length(x) AS size, sha256(strlen(r)::VARCHAR || ':' || r || x) AS k FROM b),
p AS (SELECT c, d, size, sha256(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM s UNION ALL SELECT c, 0, 0, '' FROM c),
l AS (SELECT c, max(d) AS len FROM p GROUP BY c),
n AS (SELECT p.k, p.d, min(p.c) AS conv_id, count(*) AS n_convs, any_value(p.size) AS size,
             coalesce(string_agg(CASE WHEN p.d = l.len THEN p.c::VARCHAR END, ',' ORDER BY p.c), '') AS ends
      FROM p JOIN l ON l.c = p.c GROUP BY p.k, p.d),
m AS (SELECT p.c, p.d, n.conv_id AS node FROM p JOIN n ON n.k = p.k AND n.d = p.d),
f AS (SELECT n.*, u.node AS parent_conv_id FROM n LEFT JOIN m u ON u.c = n.conv_id AND u.d = n.d - 1),
k AS (SELECT parent_conv_id AS node, d - 1 AS d, count(*) AS n_children FROM f WHERE d > 0 GROUP BY 1, 2),
g AS (SELECT f.*, coalesce(k.n_children, 0) AS n_children FROM f LEFT JOIN k ON k.node = f.conv_id AND k.d = f.d),
a AS (SELECT m.node, m.d, count(*) FILTER (g.n_children = 0) AS n_leaves, sum((g.n_convs - 1) * g.size) AS saved
      FROM g JOIN m ON m.c = g.conv_id AND m.d <= g.d GROUP BY 1, 2)
SELECT g.conv_id, g.d::BIGINT AS depth, g.parent_conv_id, g.n_convs, g.n_children::BIGINT AS n_children, a.n_leaves::BIGINT AS n_leaves,
       a.saved::BIGINT AS saved_tokens, sha256(g.ends) AS ends_sha256
FROM g JOIN a ON a.node = g.conv_id AND a.d = g.d
"""
