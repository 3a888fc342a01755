"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT c.a, c.b FROM (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id) c
  JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
named AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM named LEFT JOIN sizes USING (doc_id)
"""

OP5 = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

OP7 = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
keyed AS (
  SELECT doc_id, line, place, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
gone AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT doc_id, line, place, k IN (SELECT k FROM gone) AS drop_it FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop_it) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT drop_it), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP9 = """
WITH said AS (
  SELECT conv_id, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '<\\|') AS body, turn
  FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, md5(body)) - 1 AS place FROM said),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
seen AS (
  SELECT s.*, p.perspective,
         CASE WHEN s.speaker = p.perspective THEN 'assistant' WHEN s.speaker = 'system' THEN 'system'
              ELSE 'user' END AS as_role
  FROM placed s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (
  SELECT *, '<|im_start|>' || as_role || CASE WHEN as_role = 'user' THEN ' name=' || regexp_replace(speaker, '[\\x00-\\x20\\x7F<>|]', '_', 'g') ELSE '' END || chr(10) AS head
  FROM seen),
turns AS (
  SELECT conv_id, perspective, place // 64 AS part, place, head || body || '<|im_end|>' || chr(10) AS rendered,
         length(head) AS start_at, length(head) + length(body) + 11 AS end_at, speaker = perspective AS own
  FROM headed),
run AS (
  SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, perspective, part ORDER BY place
                                        ROWS UNBOUNDED PRECEDING) - length(rendered) AS before
  FROM turns)
SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(rendered, '' ORDER BY place) AS dialogue,
       coalesce(string_agg((before + start_at)::VARCHAR || '-' || (before + end_at)::VARCHAR, ',' ORDER BY place)
                FILTER (WHERE own), '') AS masks
FROM run GROUP BY conv_id, perspective, part
"""

_SIZED = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_SIZED.format(f"({c})") for c in ["doc_id", "source", "lang", n_chars, "text"]) + ")"


# crc32 of the decimal id, bit by bit (reflected polynomial 0xEDB88320).
_CRC = """xor(4294967295, list_reduce(
  list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda crc, b: list_reduce([0::BIGINT, 1, 2, 3, 4, 5, 6, 7],
    lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, b)), 4294967295::BIGINT))"""

OP13 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars, {_leaf('n_chars')} AS leaf, {_leaf('n_chars + 1')} AS grown,
         {_CRC} % 7 = 0 AND n_chars IS NOT NULL AS hit FROM documents),
rows AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
nodes AS (
  SELECT lang, 0 AS lvl, pos, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM rows
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2),
subs AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS langs
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, place AS pos, subroot AS digest, langs AS n FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY lvl, pos // 2),
root AS (SELECT digest AS root FROM tops WHERE n = 1),
proof AS (
  SELECT r.lang, r.pos AS leaf_pos, e.lvl,
         CASE WHEN s.pos < e.pos THEN s.digest ELSE '' END AS before,
         CASE WHEN s.pos > e.pos THEN s.digest ELSE '' END AS after
  FROM rows r JOIN nodes e ON e.lang IS NOT DISTINCT FROM r.lang AND e.pos = r.pos >> e.lvl AND e.n > 1
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM r.lang AND s.lvl = e.lvl AND s.pos = xor(e.pos, 1)
  UNION ALL
  SELECT r.lang, r.pos, 1000 + e.lvl, CASE WHEN s.pos < e.pos THEN s.digest ELSE '' END,
         CASE WHEN s.pos > e.pos THEN s.digest ELSE '' END
  FROM rows r JOIN subs u ON u.lang IS NOT DISTINCT FROM r.lang JOIN tops e ON e.pos = u.place >> e.lvl AND e.n > 1
  LEFT JOIN tops s ON s.lvl = e.lvl AND s.pos = xor(e.pos, 1)),
proofs AS (
  SELECT lang, leaf_pos, sha256(string_agg(before || after, '' ORDER BY lvl)) AS proof_sha256,
         list({{'b': before, 'a': after}} ORDER BY lvl) AS path FROM proof GROUP BY lang, leaf_pos),
-- A list_reduce over strings: the first is the leaf, the others hold what goes before and after, split by a mark.
folds AS (
  SELECT r.doc_id, r.leaf, u.subroot, root.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
         list_reduce(list_transform(coalesce(p.path, []), lambda e: e.b || '|' || e.a),
           lambda h, e: sha256(split_part(e, '|', 1) || h || split_part(e, '|', 2)),
           CASE WHEN r.hit THEN r.grown ELSE r.leaf END) AS folded_root
  FROM rows r JOIN subs u ON u.lang IS NOT DISTINCT FROM r.lang
  LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM r.lang AND p.leaf_pos = r.pos, root)
SELECT *, folded_root = root AS verified FROM folds
"""

ORACLE_SQL: dict[str, str] = {
    "op4_near_dedup": OP4,
    "op5_exact_dedup": OP5,
    "op7_line_dedup": OP7,
    "op9_chat_rotation": OP9,
    "op13_merkle_manifest": OP13,
}
