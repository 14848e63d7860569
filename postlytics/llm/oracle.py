"""DuckDB SQL for the operators that SQL can express.

The others are compared with brute force in tests/llm: language models, tokenizers, XXH64
fingerprints, HTML trees, iterated estimates and boosted trees have no SQL form, and a CRC-32 or
all 400-byte windows of every text (sharding, repeated strings) take DuckDB minutes.
"""

from __future__ import annotations

from postlytics.llm.decontaminate import WINDOW

QUERIES: dict[str, str] = {
    "op10_decontamination": f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
),
win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[p:p + least(len(w), {WINDOW}) - 1], ' ') AS words
  FROM i, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) t(p) WHERE len(w) > 0
),
lens AS (SELECT DISTINCT n FROM win),
docwin AS (
  SELECT k, p, n, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM d, lens, unnest(range(1, len(w) - n + 2)) t(p) WHERE len(w) >= n
),
hits AS (SELECT k, p, n, item FROM docwin JOIN win USING (n, words)),
found AS (SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY k),
covered AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT k, p, n FROM hits), unnest(range(p, p + n)) t(q) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN found USING (k) LEFT JOIN covered USING (k)
""",
    # h: CRC-32 of the decimal id, a byte and eight shifts at a time, modulo 4
    "op13_prefix_trie": """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list({'k': k, 'n': len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))} ORDER BY p) AS seq FROM t GROUP BY conv_id
),
heads AS (
  SELECT conv_id, seq, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
           range(1, length(conv_id::VARCHAR) + 1), lambda i: [ascii(substr(conv_id::VARCHAR, i::INT, 1)) + 1000, 0, 0, 0, 0, 0, 0, 0, 0]))),
           lambda crc, op: CASE WHEN op >= 1000 THEN xor(crc, op - 1000)
                             ELSE xor(crc >> 1, (crc & 1) * 3988292384) END)) % 4 AS h
  FROM own
),
built AS (
  SELECT c.conv_id, list_concat(coalesce(g.seq, [])[1:c.h], c.seq[c.h + 1:]) AS seq
  FROM heads c LEFT JOIN own g ON g.conv_id = c.conv_id - c.conv_id % 20
),
pre AS (
  SELECT conv_id, d, len(seq) AS m, array_to_string(list_transform(seq[1:d], lambda x: x.k), '') AS path,
         CASE WHEN d > 0 THEN seq[d].n ELSE 0 END AS words
  FROM built, unnest(range(0, len(seq) + 1)) u(d)
),
node AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = m), '')) AS ends_sha256
  FROM pre GROUP BY d, path
),
kids AS (SELECT d - 1 AS d, left(path, 32 * (d - 1)::INT) AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
below AS (
  SELECT a AS d, left(n.path, 32 * a::INT) AS path, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (k.path IS NULL) AS leaves
  FROM node n LEFT JOIN kids k ON k.d = n.d AND k.path = n.path, unnest(range(0, n.d + 1)) u(a) GROUP BY 1, 2
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(k.n_children, 0)::BIGINT AS n_children, b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM node n LEFT JOIN kids k ON k.d = n.d AND k.path = n.path JOIN below b ON b.d = n.d AND b.path = n.path
     LEFT JOIN node p ON n.d > 0 AND p.d = n.d - 1 AND p.path = left(n.path, 32 * (n.d - 1)::INT)
""",
}
