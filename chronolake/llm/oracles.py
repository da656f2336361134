"""Reference SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP1 = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
),
-- Share, cut at three times the size, share the excess again: at most one source fills up last.
r AS (
  SELECT *, sum(source_size) OVER ()
              - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
            sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM s WINDOW f AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST)
),
l AS (
  SELECT max(CAST(rest AS DOUBLE) / CAST(open_weight AS DOUBLE))
         FILTER (CAST(rest AS DOUBLE) / CAST(open_weight AS DOUBLE) * weight <= 3 * source_size) AS level FROM r
),
t AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * level) AS target,
         CASE WHEN source_size > 0 THEN least(CAST(3 * source_size AS DOUBLE), weight * level) / source_size
              ELSE 0.0 END AS e
  FROM s, l
),
p AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.e,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
-- Of sixteen random offsets for each source, the one whose words come nearest to the target.
u AS (
  SELECT source, i, CAST('0x' || substr(md5('mixing:' || i || ':' || coalesce(source, chr(0))), 1, 13) AS BIGINT)
                    / CAST(4503599627370496 AS DOUBLE) AS u
  FROM t, range(16) AS draws(i)
),
w AS (
  SELECT p.source, u.i, any_value(u.u) AS u,
         abs(sum(CAST(size * (floor(place * e + u.u) - floor((place - 1) * e + u.u)) AS BIGINT)) - any_value(target)) AS off
  FROM p JOIN u ON p.source IS NOT DISTINCT FROM u.source
  GROUP BY p.source, u.i
),
b AS (SELECT source, u FROM w QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, i) = 1)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(place * e + u) - floor((place - 1) * e + u)) AS BIGINT) AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""

OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


# crc32 of an id as decimal text, byte by byte with the usual table.
OP11 = r"""
WITH RECURSIVE steps(n, k, c) AS (
  SELECT n, 0, n FROM range(256) AS r(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM steps WHERE k < 8
),
crc(c, name, i, v) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT crc.c, name, i + 1, xor(v >> 8, steps.c)
  FROM crc JOIN steps ON steps.k = 8 AND steps.n = xor(v, CAST(ascii(substr(name, i + 1, 1)) AS BIGINT)) & 255
  WHERE i < length(name)
),
t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
         length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS id,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS words
  FROM conversations WHERE conv_id IS NOT NULL
),
h AS (
  SELECT c, xor(v, CAST(4294967295 AS BIGINT)) % 4 AS h, c - c % 20 AS base FROM crc WHERE i = length(name)
),
b AS (
  SELECT h.c, 0 AS part, t.pos, t.id, t.words FROM h JOIN t ON t.c = h.base AND t.pos < h.h
  UNION ALL
  SELECT h.c, 1 AS part, t.pos, t.id, t.words FROM h JOIN t ON t.c = h.c AND t.pos >= h.h
),
s AS (
  SELECT h.c, coalesce(list(b.id ORDER BY b.part, b.pos) FILTER (b.id IS NOT NULL), []) AS ids,
         coalesce(list(b.words ORDER BY b.part, b.pos) FILTER (b.id IS NOT NULL), []) AS words
  FROM h LEFT JOIN b USING (c) GROUP BY h.c
),
m AS (
  SELECT s.c, d, ids[1:d] AS node, CASE WHEN d > 0 THEN ids[1:d-1] END AS up,
         CASE WHEN d > 0 THEN words[d] ELSE 0 END AS word, d = len(ids) AS ends
  FROM s, unnest(range(len(ids) + 1)) AS r(d)
),
n AS (
  SELECT node, any_value(up) AS up, min(c) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, any_value(word) AS word,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY node
),
k AS (SELECT up AS node, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
a AS (
  SELECT node[1:e] AS node, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * word) AS saved
  FROM (SELECT * FROM n LEFT JOIN k USING (node)) AS x, unnest(range(len(node) + 1)) AS r(e) GROUP BY node[1:e]
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n LEFT JOIN n AS p ON n.up = p.node LEFT JOIN k ON n.node = k.node JOIN a ON n.node = a.node
"""

_VALID = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

# Squared distances from inner products: whole numbers, exact in doubles.
_ROUND = """
a{r} AS MATERIALIZED (
  SELECT vec_id, part, min({{'d': p.xx + e.cc - 2 * list_dot_product(p.x, e.c), 'entry': e.entry}}) AS best
  FROM p JOIN e{r} e USING (part) GROUP BY vec_id, part
),"""

_MOVE = """
e{n} AS MATERIALIZED (
  SELECT part, entry, coalesce(g.c, e.c) AS c, list_dot_product(coalesce(g.c, e.c), coalesce(g.c, e.c)) AS cc
  FROM e{r} e LEFT JOIN (
    SELECT part, entry, list(c ORDER BY place) AS c FROM (
      SELECT a.part, a.best.entry AS entry, u.place, CAST(floor(sum(p.x[u.place]) / count(*)) AS DOUBLE) AS c
      FROM a{r} a JOIN p USING (vec_id, part), unnest(range(1, len(p.x) + 1)) AS u(place)
      GROUP BY a.part, a.best.entry, u.place
    ) GROUP BY part, entry
  ) g USING (part, entry)
),"""

OP12 = (
    f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS place,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vec
  FROM embeddings WHERE {_VALID}
),
p AS MATERIALIZED (
  SELECT *, list_dot_product(x, x) AS xx FROM (
    SELECT vec_id, place, part, vec[part * len(vec) // 4 + 1:(part + 1) * len(vec) // 4] AS x FROM v, range(4) AS r(part)
  )
),
e0 AS MATERIALIZED (SELECT part, place AS entry, x AS c, xx AS cc FROM p WHERE place < 256),"""
    + "".join(_ROUND.format(r=r) + _MOVE.format(r=r, n=r + 1) for r in range(4))
    + _ROUND.format(r=4)
    + """
s AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY part, entry)) AS sha FROM e4),
f AS (
  SELECT vec_id, string_agg(lower(printf('%02x', best.entry)), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a4 GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM f JOIN v USING (vec_id), s
"""
)

# Five hex digits are four base32 digits.
OP13 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS hex,
         max(page_id) OVER same AS top, row_number() OVER (same ORDER BY page_id DESC) = 1 AS is_first
  FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))
)
SELECT page_id, size AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN is_first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN NOT is_first THEN top END AS refers_to
FROM p
"""


def sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1,
        "op3_mixing": OP3,
        "op6_top_k": OP6,
        "op11_conversation_trie": OP11,
        "op12_vector_codes": OP12,
        "op13_warc": OP13,
    }
