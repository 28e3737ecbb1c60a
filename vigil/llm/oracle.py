"""DuckDB SQL of the registered queries that SQL can express."""
from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op10_preference_format"] = r"""
WITH ans AS (  -- the last answer of each conversation
  SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS answer
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
sides AS (
  SELECT c.conv_id, 'chosen' AS side, c.turn, c.role, c.text
  FROM conversations c LEFT JOIN ans a USING (conv_id) WHERE c.turn <= coalesce(a.last_turn, c.turn)
  UNION ALL
  SELECT c.conv_id, 'rejected', c.turn, c.role, c.text
  FROM conversations c LEFT JOIN ans a USING (conv_id) WHERE a.last_turn IS NULL OR c.turn < a.last_turn
  UNION ALL
  SELECT a.conv_id, 'rejected', a.last_turn, 'assistant', b.answer
  FROM ans a JOIN ans b ON b.conv_id = xor(a.conv_id, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn) AS k FROM sides),
first_difference AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, min(coalesce(a.k, b.k)) AS k
  FROM (SELECT * FROM numbered WHERE side = 'chosen') a
  FULL JOIN (SELECT * FROM numbered WHERE side = 'rejected') b ON a.conv_id = b.conv_id AND a.k = b.k
  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text OR a.k IS NULL OR b.k IS NULL
  GROUP BY 1),
marked AS (
  SELECT n.conv_id, n.side, n.k, n.role, coalesce(d.k - 1, 1000000000) AS shared,
         '<|im_start|>' || n.role || chr(10) AS head, n.text || '<|im_end|>' AS body
  FROM numbered n LEFT JOIN first_difference d USING (conv_id)),
placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, side ORDER BY k) - length(body) - 1 AS body_start
  FROM marked WHERE k > shared),
completions AS (
  SELECT conv_id, side, string_agg(head || body || chr(10), '' ORDER BY k) AS rendered,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN body_start::BIGINT || ':' || (body_start + length(body))::BIGINT END, ',' ORDER BY k), '') AS loss
  FROM placed GROUP BY 1, 2),
prompts AS (
  SELECT conv_id, count(*) FILTER (k <= shared) AS prompt_turns,
         coalesce(string_agg(head || body || chr(10), '' ORDER BY k) FILTER (k <= shared), '') AS prompt
  FROM marked WHERE side = 'chosen' GROUP BY 1)
SELECT p.conv_id, p.prompt, p.prompt_turns, coalesce(c.rendered, '') AS chosen, coalesce(c.loss, '') AS chosen_loss,
       coalesce(r.rendered, '') AS rejected, coalesce(r.loss, '') AS rejected_loss
FROM prompts p
LEFT JOIN completions c ON c.conv_id = p.conv_id AND c.side = 'chosen'
LEFT JOIN completions r ON r.conv_id = p.conv_id AND r.side = 'rejected'
"""

ORACLE["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
t AS (SELECT id, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS c FROM t GROUP BY ALL),
filled AS (
  SELECT lang, source, term, total, coalesce(c, 0) AS c
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (
  SELECT f.lang, f.source, f.term, f.c,
         1 + (1000000000::HUGEINT * (f.c + 1)) // (sum(f.c) OVER (PARTITION BY f.lang, f.source) + l.v) AS p,
         1 + (1000000000::HUGEINT * (f.total + 1)) // (l.n + l.v) AS q
  FROM filled f JOIN langs l USING (lang)),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 200
"""

# crc32 is written out (DuckDB has none); the parse runs row by row over four states: nothing yet, after
# s, after u, after a.  A state holds eight digits of cost and the edits, so the least text is the best repair.
ORACLE["op13_conversation_repair"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
picked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT)),
               lambda c, b: xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1]))) % 20 AS pick
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN pick = 1 THEN '' WHEN pick = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN pick = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM picked WHERE pick <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS initial, lead(left(role, 1)) OVER w AS next_initial,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
faults AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (next_initial IS NOT NULL AND initial || next_initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, '00000000' AS v0, NULL::VARCHAR AS v1, '00000003I' AS v2, '00000006II' AS v3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, v0, v1, v2, least(v3, lpad((left(v2, 8)::INT + 3)::VARCHAR, 8, '0') || v2[9:] || 'I') AS v3
  FROM (SELECT conv_id, i, v0, v1, v3,
               least(v2, lpad((left(v0, 8)::INT + 3)::VARCHAR, 8, '0') || v0[9:] || 'I', lpad((left(v1, 8)::INT + 3)::VARCHAR, 8, '0') || v1[9:] || 'I',
                     lpad((left(v3, 8)::INT + 3)::VARCHAR, 8, '0') || v3[9:] || 'I') AS v2
        FROM (SELECT s.conv_id, r.i,
                     lpad((left(v0, 8)::INT + 4)::VARCHAR, 8, '0') || v0[9:] || 'D' AS v0,
                     least(lpad((left(v1, 8)::INT + 4)::VARCHAR, 8, '0') || v1[9:] || 'D',
                           CASE WHEN k AND initial = 's' THEN lpad((left(v0, 8)::INT + t)::VARCHAR, 8, '0') || v0[9:] || 'K' END) AS v1,
                     least(lpad((left(v2, 8)::INT + 4)::VARCHAR, 8, '0') || v2[9:] || 'D',
                           CASE WHEN k AND initial = 'u' THEN least(lpad((left(v0, 8)::INT + t)::VARCHAR, 8, '0') || v0[9:] || 'K',
                             lpad((left(v1, 8)::INT + t)::VARCHAR, 8, '0') || v1[9:] || 'K', lpad((left(v3, 8)::INT + t)::VARCHAR, 8, '0') || v3[9:] || 'K') END,
                           CASE WHEN k THEN least(lpad((left(v0, 8)::INT + t + 3)::VARCHAR, 8, '0') || v0[9:] || 'R',
                             lpad((left(v1, 8)::INT + t + 3)::VARCHAR, 8, '0') || v1[9:] || 'R', lpad((left(v3, 8)::INT + t + 3)::VARCHAR, 8, '0') || v3[9:] || 'R') END) AS v2,
                     least(lpad((left(v3, 8)::INT + 4)::VARCHAR, 8, '0') || v3[9:] || 'D',
                           CASE WHEN k AND initial = 'a' THEN lpad((left(v2, 8)::INT + t)::VARCHAR, 8, '0') || v2[9:] || 'K' END,
                           CASE WHEN k THEN lpad((left(v2, 8)::INT + t + 3)::VARCHAR, 8, '0') || v2[9:] || 'R' END) AS v3
              FROM steps s JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS k, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS t FROM faults) r
                ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1))),
best AS (
  SELECT s.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
         coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, least(s.v0, s.v3) AS v
  FROM steps s LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id WHERE s.i = coalesce(c.n, 0)),
edits AS (
  SELECT conv_id, e.pos, v[8 + e.pos] AS edit,
         count(*) FILTER (v[8 + e.pos] <> 'I') OVER (PARTITION BY conv_id ORDER BY e.pos) AS row_i,
         count(*) FILTER (v[8 + e.pos] <> 'D') OVER (PARTITION BY conv_id ORDER BY e.pos) AS out_i
  FROM best, unnest(range(1, length(v) - 7)) AS e(pos)),
lines AS (
  SELECT e.*, CASE WHEN e.edit <> 'I' THEN f.text ELSE '' END AS text, f.role,
         coalesce(max(CASE WHEN e.out_i = 1 AND e.edit = 'K' AND f.initial = 's' THEN 1 END) OVER (PARTITION BY e.conv_id), 0) AS led
  FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.row_i
  WHERE e.edit <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (out_i - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS repaired
  FROM lines GROUP BY conv_id)
SELECT b.conv_id, gaps, blank, duplicate, truncated, illegal, left(v, 8)::BIGINT AS cost, v[9:] AS audit, sha256(coalesce(t.repaired, '')) AS repaired_sha256
FROM best b LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM b.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
