"""The trie of ``prefix_trie.trie`` in DuckDB SQL, over the rebuilt turns themselves."""

from __future__ import annotations

from sieveline.llm.prefix_trie import FAMILY, HEADS

# CRC-32 bit by bit: every eighth step brings in the next byte of the digits.
_BITS = "[CASE WHEN i % 8 = 0 THEN CAST(ascii(substr(s, CAST(i // 8 + 1 AS INTEGER), 1)) AS BIGINT) ELSE 0 END for i in range(8 * length(s))]"
_STEP = "lambda c, b: CASE WHEN xor(c, b) % 2 = 1 THEN xor(xor(c, b) // 2, 3988292384) ELSE xor(c, b) // 2 END"
_CRC = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_BITS}), {_STEP}), 4294967295)"

TRIE = f"""
WITH turns AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce("text", '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, own, {_CRC} % {HEADS} AS h FROM (SELECT conv_id, own, CAST(conv_id AS VARCHAR) AS s FROM turns)),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS seq
  FROM heads c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
members AS (
  SELECT conv_id, d, seq[1:d] AS prefix, len(seq) = d AS is_end FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256,
         CASE WHEN d > 0 THEN (count(*) - 1) * octet_length(encode(prefix[d].text)) ELSE 0 END AS charge
  FROM members GROUP BY d, prefix),
kids AS (SELECT d - 1 AS d, prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
tree AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.d = k.d AND n.prefix = k.prefix),
above AS (SELECT charge, n_children, unnest(range(0, d + 1)) AS top, prefix FROM tree),
sums AS (
  SELECT top AS d, prefix[1:top] AS prefix, sum(charge) AS saved, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM above GROUP BY 1, 2)
SELECT t.conv_id, CAST(t.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, t.n_convs, CAST(t.n_children AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM tree t JOIN sums s ON t.d = s.d AND t.prefix = s.prefix
LEFT JOIN nodes p ON p.d = t.d - 1 AND p.prefix = t.prefix[1:t.d - 1]"""
