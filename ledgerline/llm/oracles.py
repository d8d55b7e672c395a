"""DuckDB SQL for the queries that SQL can express, written without the operators' code."""

from __future__ import annotations

from ledgerline.llm.licenses import KNOWN, SPELLINGS

OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), lengths AS (
  SELECT *, length('<|turn|>') + length('<|content|>') + length('<|end|>')
    + length(replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'))
    + length(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) AS chars
  FROM turns
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id
"""

OP3 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[ \t\n\v\f\r]+'), lambda w: w <> '') AS w
  FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS s FROM starts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, CAST(min(r.y) AS BIGINT) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, s.n
"""

OP4 = r"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, greatest(CAST(length(h) / 2 AS BIGINT) - 49, 0))) AS p FROM docs)
), firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)
), hits AS (
  SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM windows JOIN firsts USING (w) WHERE first < doc_id)
), spans AS (
  SELECT doc_id, min(p) AS lo, max(p) + 1 AS hi FROM hits GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS lo, lo AS hi FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(hi), 0), any_value(CAST(length(h) / 2 AS BIGINT)) FROM docs d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
), kept AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo) AS k FROM gaps g JOIN docs d ON d.doc_id = g.doc_id GROUP BY g.doc_id
)
SELECT d.doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST((length(h) - length(k)) / 2 AS BIGINT) AS n_removed,
  CAST((SELECT count(*) FROM spans s WHERE s.doc_id = d.doc_id) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM docs d JOIN kept USING (doc_id)
"""

OP6 = r"""
WITH parsed AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
  UNION ALL SELECT 'i', CAST(item_id AS VARCHAR), text FROM benchmark
), words AS (
  SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM parsed
), items AS (
  SELECT id, w, least(13, len(w)) AS size FROM words WHERE kind = 'i' AND len(w) > 0
), item_windows AS (
  SELECT DISTINCT id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS s
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM items)
), doc_windows AS (
  SELECT id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS s
  FROM (SELECT id, w, z.size, unnest(range(1, greatest(len(w) - z.size + 2, 1))) AS i
        FROM words, (SELECT DISTINCT size FROM items) z WHERE kind = 'd')
), found AS (
  SELECT d.id AS doc, d.i, d.size, w.id AS item FROM doc_windows d JOIN item_windows w ON d.size = w.size AND d.s = w.s
), hit AS (
  SELECT doc, count(DISTINCT p) AS n FROM (SELECT doc, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc
), named AS (
  SELECT doc, count(item) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc, item FROM found) GROUP BY doc
)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(m.names, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN hit h ON h.doc = w.id LEFT JOIN named m ON m.doc = w.id WHERE w.kind = 'd'
"""

OP12 = r"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS r, digest, size
  FROM (SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
               octet_length(encode(coalesce(text, ''))) AS size FROM conversations WHERE conv_id IS NOT NULL)
), ids AS (
  -- CRC-32 bit by bit: a byte goes in (its value), then eight shifts (-1 each).
  SELECT c, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
              lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns)
), seq AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY src, r) AS d, digest, size
  FROM (SELECT i.c, 0 AS src, t.r, t.digest, t.size FROM ids i JOIN turns t ON t.c = i.c - i.c % 5 AND t.r <= i.h
        UNION ALL SELECT i.c, 1, t.r, t.digest, t.size FROM ids i JOIN turns t ON t.c = i.c AND t.r > i.h)
), whole AS (
  SELECT i.c, coalesce(string_agg(s.digest, '' ORDER BY d), '') AS path FROM ids i LEFT JOIN seq s ON s.c = i.c GROUP BY i.c
), member AS (
  SELECT m.c, m.d, left(path, 32 * m.d) AS k, length(path) = 32 * m.d AS ended, coalesce(s.size, 0) AS size
  FROM (SELECT c, path, CAST(unnest(range(0, CAST(length(path) / 32 AS BIGINT) + 1)) AS BIGINT) AS d FROM whole) m LEFT JOIN seq s ON s.c = m.c AND s.d = m.d
), node AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
  FROM member GROUP BY d, k
), children AS (
  SELECT left(k, 32 * (d - 1)) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
), under AS (
  SELECT left(k, 32 * a) AS k, sum(leaf) AS leaves, sum(cost) AS saved
  FROM (SELECT n.k, CASE WHEN ch.n IS NULL THEN 1 ELSE 0 END AS leaf, (n.n - 1) * n.size AS cost, unnest(range(0, n.d + 1)) AS a
        FROM node n LEFT JOIN children ch ON ch.k = n.k)
  GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs, CAST(coalesce(ch.n, 0) AS BIGINT) AS n_children,
  CAST(u.leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n LEFT JOIN node p ON n.d > 0 AND p.k = left(n.k, 32 * (n.d - 1)) LEFT JOIN children ch ON ch.k = n.k JOIN under u ON u.k = n.k
"""

OP13 = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT doc_id, i, l[i] AS line,
    translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM split)
), common AS (
  SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT l.doc_id, i, line, c.last IS NOT NULL AND c.last <> l.doc_id AS gone FROM lines l LEFT JOIN common c ON c.k = l.k
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _canonical(text: str) -> str:
    sql = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"regexp_replace({sql}, '(^|\\n)[^a-z0-9\\n©]*(copyright|\\(c\\)|©|all rights reserved|portions copyright)[^\\n]*', '\\1', 'g')"
    sql = f"translate({sql}, '‘’“”–—… «»•·﻿', '             ')"
    sql = f"trim(regexp_replace({sql}, '[\\x00-/:-`{{-\\x7f]+', ' ', 'g'))"
    for pattern, spelling in SPELLINGS:  # fixed values, shared with the operator
        sql = f"regexp_replace({sql}, '{pattern}', '{spelling.replace('$', chr(92))}', 'g')"
    return sql


def _op5() -> str:
    known = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in sorted(KNOWN.items()))
    return f"""
WITH known AS (
  SELECT sha256(c) AS digest, min(id) AS license_id FROM (SELECT id, {_canonical("text")} AS c FROM (VALUES {known}) k(id, text)) GROUP BY 1
)
SELECT doc_id, digest AS canonical_sha256, license_id, license_id IS NOT NULL AS is_license
FROM (SELECT doc_id, sha256({_canonical("coalesce(text, '')")}) AS digest FROM documents) d LEFT JOIN known USING (digest)
"""


ORACLES = {
    "op1_chat_format": OP1,
    "op3_ngram_join": OP3,
    "op4_suffix_dedup": OP4,
    "op5_license_scan": _op5(),
    "op6_decontamination": OP6,
    "op12_prefix_trie": OP12,
    "op13_line_dedup": OP13,
}
