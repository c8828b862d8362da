"""The results of queries that SQL can express, in DuckDB SQL."""

from __future__ import annotations

from sieveline.llm.divergence import CLASSES, SYMBOLS, Limits
from sieveline.llm.oracle_centroids import CENTROIDS
from sieveline.llm.oracle_trie import TRIE

LIMITS = Limits()
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

WARC = """
WITH q AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS payload_digest
  FROM pages),
g AS (SELECT payload_digest, max(page_id) AS top FROM q WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT q.page_id, q.payload_bytes, q.payload_digest,
       CASE WHEN g.top <> q.page_id OR (q.page_id IS NULL AND g.top IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.top <> q.page_id OR q.page_id IS NULL THEN g.top END AS refers_to
FROM q LEFT JOIN g ON q.payload_digest = g.payload_digest AND q.payload_bytes >= 1000"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS ws FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] END) AS s
  FROM w),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n >= 80 * (len(a.s) + len(b.s) - n)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM sets
  UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON reach.r = edges.x)
SELECT sets.doc_id, len(sets.s) AS n_shingles, min(reach.r) AS component_id
FROM sets JOIN reach ON sets.doc_id = reach.doc_id GROUP BY sets.doc_id, len(sets.s)"""


def _part(p: str, q: str) -> str:
    """One category's share of the Jensen-Shannon divergence."""
    side = "CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0 END"
    return f"({side.format(x=p, p=p, q=q)} + {side.format(x=q, p=p, q=q)}) / 2"


def _strip(depth: int) -> str:
    text = "t"
    for pattern in list(CLASSES.values())[:depth]:
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    return text


_COUNTS = ", ".join(
    [f"length({_strip(k)}) - length({_strip(k + 1)}) AS c{k}" for k in range(len(CLASSES))] + [f"length({_strip(len(CLASSES))}) AS c{len(CLASSES)}"]
)
_ALL = range(len(CLASSES) + 1)
_CLASS_PARTS = " + ".join(_part(f"(m.c{k} / m.chars)", f"(r.c{k} / r.letters)") for k in _ALL)

DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, lang, t, regexp_extract_all(t, '{WORD}') AS ws FROM d),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
repeated AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM repeated CROSS JOIN (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
measured AS (
  SELECT w.rid, doc_id, lang, t, ws, len(ws) AS n_words, length(t) AS chars,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[{SYMBOLS.replace("$", "$")}]', '', 'g')) AS n_symbols,
         len([x for x in string_split(t, chr(10)) if regexp_matches(x, '{WORD}')])
           - len(list_distinct([x for x in string_split(t, chr(10)) if regexp_matches(x, '{WORD}')])) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, {_COUNTS}
  FROM w LEFT JOIN covered ON w.rid = covered.rid),
totals AS (
  SELECT lang, sum(n_words) AS total, sum(chars) AS letters, {", ".join(f"sum(c{k}) AS c{k}" for k in _ALL)} FROM measured GROUP BY lang),
refs AS (
  SELECT lang AS ref, total, letters, {", ".join(f"c{k}" for k in _ALL)} FROM totals
  WHERE lang <> '' AND total >= greatest(1, {LIMITS.language_share} * (SELECT sum(total) FROM totals))
  UNION ALL SELECT '*', sum(total), sum(letters), {", ".join(f"sum(c{k})" for k in _ALL)} FROM totals),
counts AS (SELECT lang, unnest(ws) AS word FROM w),
common AS (
  SELECT r.ref, c.word, count(*) / r.total AS q FROM refs r JOIN counts c ON r.ref = c.lang OR r.ref = '*'
  GROUP BY r.ref, r.total, c.word HAVING count(*) >= greatest(1, {LIMITS.common_share} * r.total)),
named AS (SELECT m.*, coalesce(r.ref, '*') AS ref FROM measured m LEFT JOIN refs r ON m.lang = r.ref AND r.ref <> '*'),
own AS (SELECT rid, word, count(*) AS n FROM (SELECT rid, unnest(ws) AS word FROM w) GROUP BY rid, word),
shares AS (
  SELECT n.rid, c.ref, c.ref = n.ref AS is_own, coalesce(o.n, 0) / n.n_words AS p, c.q
  FROM named n JOIN common c ON n.ref = c.ref OR n.ref = '*' LEFT JOIN own o ON o.rid = n.rid AND o.word = c.word
  WHERE n.n_words >= {LIMITS.min_words}),
summed AS (
  SELECT rid, is_own, sum({_part("p", "q")}) AS parts, greatest(0, 1 - sum(p)) AS rest_p, sum(q) AS share, greatest(0, 1 - sum(q)) AS rest_q
  FROM shares GROUP BY rid, ref, is_own),
distances AS (
  SELECT rid, is_own, sqrt(greatest(0, parts + {_part("rest_p", "rest_q")})) AS distance,
         sqrt((share + log2(2 / (1 + rest_q)) + CASE WHEN rest_q > 0 THEN rest_q * log2(2 * rest_q / (1 + rest_q)) ELSE 0 END) / 2) AS bare
  FROM summed),
words_far AS (SELECT rid, max(distance) FILTER (WHERE is_own) AS distance, min(distance / bare) AS lacking FROM distances GROUP BY rid),
far AS (
  SELECT m.rid, CASE WHEN m.chars >= {LIMITS.min_chars} THEN sqrt(greatest(0, {_CLASS_PARTS})) END AS distance
  FROM named m JOIN refs r ON m.ref = r.ref)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words,
       m.n_words < 10 OR 100 * m.n_repeat_words > 20 * m.n_words AS base_failed,
       NOT (m.n_words < 10 OR 100 * m.n_repeat_words > 20 * m.n_words)
         AND coalesce(words_far.distance <= {LIMITS.word_distance}, true) AND coalesce(words_far.lacking <= {LIMITS.bare_share}, true)
         AND coalesce(far.distance <= {LIMITS.class_distance}, true) AS kept
FROM named m LEFT JOIN words_far ON m.rid = words_far.rid LEFT JOIN far ON m.rid = far.rid"""

ORACLES: dict[str, str] = {
    "op4_warc": WARC,
    "op5_ngram_join": NGRAM_JOIN,
    "op8_divergence": DIVERGENCE,
    "op11_prefix_trie": TRIE,
    "op12_centroids": CENTROIDS,
}
