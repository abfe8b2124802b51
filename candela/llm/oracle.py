"""DuckDB SQL of the numbered operators that SQL can express, written from their definitions."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

DOCS = f"""docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents)"""

OP3 = rf"""WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [ws] ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i:i + 3]) END) AS shingle
  FROM docs),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS start, doc_id AS node FROM docs
  UNION SELECT reach.start, y FROM reach JOIN both_ways ON x = reach.node),
least AS (SELECT start AS doc_id, min(node) AS component_id FROM reach GROUP BY 1)
SELECT docs.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, docs.doc_id = component_id AS kept
FROM docs JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

_FIVE = "strpos('0123456789abcdef', substr(h, 5 * g + {k}, 1)) - 1"
_VALUE = "(" + " + ".join(f"({_FIVE.format(k=k)}) * {16 ** (5 - k)}" for k in range(1, 6)) + ")"
_LETTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_VALUE} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0))

OP5 = f"""WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: {_LETTERS}), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM p"""

OP7 = rf"""WITH {DOCS},
grams AS (SELECT r, i, ws[i:i + 4] AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM docs WHERE len(ws) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range(0, 5)) AS k FROM twice) GROUP BY 1),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines,
    coalesce(hit.n, 0) AS n_repeat_words,
    len(regexp_extract_all(t, '[A-Z]')) AS upper, len(regexp_extract_all(t, '[A-Za-z]')) AS letters
  FROM docs LEFT JOIN hit USING (r)),
b AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * upper > letters OR 100 * n_dup_lines > 30 * len(lines)
       OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM b"""

OP8 = rf"""WITH {DOCS},
windows AS (SELECT r, i, ws[i:i + 34] AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM docs WHERE len(ws) >= 35)),
more AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY gram) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT r, i + k AS place FROM (SELECT r, i, unnest(range(0, 35)) AS k FROM more)),
placed AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM docs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM placed ANTI JOIN gone USING (r, place) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

OP11 = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(range(1, least(len(a.e), len(b.e)) + 1), lambda i: a.e[i] * b.e[i])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 10"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest(ts) AS term FROM d) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY 1),
ws AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM dfs, total),
ms AS (SELECT r, 100 - 90 + (90 * len(ts) * n_docs) // n_terms AS m FROM d, total WHERE len(ts) > 0),
scores AS (
  SELECT item_id, tfs.r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tfs USING (term) JOIN ws USING (term) JOIN ms ON ms.r = tfs.r GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"""
