"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op7_decontamination"] = r"""
WITH dw AS (
  SELECT rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
bw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(
           coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i + 1, i + 10), ' ') AS win,
         len(list_slice(w, i + 1, i + 10)) AS n
  FROM (SELECT item_id, w, unnest(range(0, greatest(0, len(w) - 10) + 1)) AS i
        FROM bw WHERE len(w) > 0)),
ws AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM dw),
nxt AS (
  SELECT rid, i, list(word) OVER (PARTITION BY rid ORDER BY i
                                  ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM ws),
pos AS (
  SELECT rid, i, n, array_to_string(list_slice(l, 1, n), ' ') AS win
  FROM nxt, (SELECT DISTINCT n FROM win) WHERE len(l) >= n),
hit AS (
  SELECT DISTINCT rid, i, pos.n, item_id
  FROM pos JOIN win ON win.win = pos.win AND win.n = pos.n),
cover AS (
  SELECT rid, count(*) AS n_hit FROM (
    SELECT DISTINCT rid, unnest(range(i, i + n)) AS k FROM hit) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN cover c USING (rid) LEFT JOIN its i USING (rid)
"""

# Four groups of 40 bits of the digest, eight base-32 digits each.
ORACLE_SQL["op12_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
  FROM pages)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(x, 1 + 10 * (i // 8), 10) AS BIGINT)
                    >> (35 - 5 * (i % 8))) & 31) AS BIGINT), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p
"""

# The crc of a decimal number, bit by bit: each byte is followed by eight steps.
ORACLE_SQL["op13_conversation_trie"] = r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i,
         md5(coalesce(role, '')) || md5(coalesce(text, '')) AS k,
         length(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, count(*) AS own FROM t GROUP BY c),
crc AS (
  SELECT c, CAST(c AS VARCHAR) AS s, 0 AS step, CAST(4294967295 AS BIGINT) AS r FROM ids
  UNION ALL
  SELECT c, s, step + 1,
         CASE WHEN step % 9 = 0 THEN xor(r, CAST(ascii(substr(s, step // 9 + 1, 1)) AS BIGINT))
              ELSE xor(r >> 1, 3988292384 * (r & 1)) END
  FROM crc WHERE step < 9 * length(s)),
h AS (
  SELECT ids.c, own, xor(r, CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM ids JOIN crc ON crc.c = ids.c AND step = 9 * length(s)),
g AS (
  SELECT h.*, least(h.h, coalesce(b.own, 0)) AS m
  FROM h LEFT JOIN ids b ON b.c = h.c - h.c % 100),
turns AS (
  SELECT g.c, t.i AS p, k, n FROM g JOIN t ON t.c = g.c - g.c % 100 AND t.i < g.m
  UNION ALL
  SELECT g.c, m + t.i - h, k, n FROM g JOIN t ON t.c = g.c AND t.i >= g.h),
seq AS (
  SELECT c, p + 1 AS d, n, md5(string_agg(k, '') OVER w) AS k,
         CASE WHEN p = 0 THEN md5('') ELSE md5(string_agg(k, '') OVER v) END AS up
  FROM turns
  WINDOW w AS (PARTITION BY c ORDER BY p ROWS UNBOUNDED PRECEDING),
         v AS (PARTITION BY c ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  UNION ALL
  SELECT c, 0, 0, md5(''), NULL FROM ids),
node AS (
  SELECT d, k, any_value(up) AS up, min(c) AS conv, count(*) AS members, any_value(n) AS n
  FROM seq GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1, 2),
full_ AS (
  SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kids USING (d, k)),
below AS (
  SELECT s.d, s.k, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves,
         sum((members - 1) * f.n) AS saved
  FROM full_ f JOIN seq s ON s.c = f.conv AND s.d <= f.d GROUP BY s.d, s.k),
last_ AS (SELECT c, max(d) AS d, arg_max(k, d) AS k FROM seq GROUP BY c),
ends AS (
  SELECT d, k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM last_ GROUP BY d, k)
SELECT f.conv AS conv_id, CAST(f.d AS BIGINT) AS depth, p.conv AS parent_conv_id,
       CAST(f.members AS BIGINT) AS n_convs, CAST(f.kids AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM full_ f JOIN below b ON b.d = f.d AND b.k = f.k
LEFT JOIN node p ON p.d = f.d - 1 AND p.k = f.up
LEFT JOIN ends e ON e.d = f.d AND e.k = f.k
"""
