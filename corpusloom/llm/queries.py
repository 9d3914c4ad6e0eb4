"""The subpackage's queries, and SQL for those that SQL can express."""

from __future__ import annotations

from corpusloom.llm.byte_pairs import op11_byte_bpe
from corpusloom.llm.chats import op10_chat_format
from corpusloom.llm.chosen_path import op9_jaccard_join
from corpusloom.llm.exact import op6_exact_dedup
from corpusloom.llm.fingerprint import near_links_of_documents, op1_fingerprints
from corpusloom.llm.languages import op8_language_id
from corpusloom.llm.line_runs import op4_line_dedup
from corpusloom.llm.mixing import op7_mixing
from corpusloom.llm.pieces import op5_sentencepiece
from corpusloom.llm.prefix_trie import op12_prefix_trie
from corpusloom.llm.quality import op3_quality
from corpusloom.llm.repairs import op13_structure_repair
from corpusloom.llm.substrings import op2_substring_dedup

QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_substring_dedup, op3_quality, op4_line_dedup, op5_sentencepiece, op6_exact_dedup, op7_mixing, op8_language_id,
        op9_jaccard_join, near_links_of_documents, op10_chat_format, op11_byte_bpe, op12_prefix_trie, op13_structure_repair,
    )
}

_UNITS = """
raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
numbered AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS n FROM raw),
placed AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS beg,
                  regexp_matches(line, '[^\\s]') AS solid FROM numbered),
units AS (SELECT *, CASE WHEN solid THEN sum(CASE WHEN solid THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) - 1 END AS pos FROM placed)
"""

_CLEANED = """
marked AS (SELECT u.*, g.pos IS NOT NULL AS cut FROM units u LEFT JOIN gone g ON u.doc_id = g.doc_id AND u.pos = g.pos),
done AS (SELECT doc_id, count(*) FILTER (cut)::INT AS n_removed, coalesce(sum(length(line)) FILTER (cut), 0)::INT AS chars_removed,
    coalesce(string_agg((beg::BIGINT)::VARCHAR || '-' || ((beg + length(line))::BIGINT)::VARCHAR, ',' ORDER BY n) FILTER (cut), '') AS removed_spans,
    coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT cut), '') AS cleaned FROM marked GROUP BY doc_id)
"""

def _crc(text: str) -> str:
    """CRC-32 of an ASCII text in SQL."""
    byte = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)), lambda c, b: {byte}), 4294967295)"


ORACLES = {
    "op2_substring_dedup": """
WITH raw AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '\\s*\\S+') AS parts FROM documents),
pieces AS (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM raw),
words AS (SELECT doc_id, i, regexp_extract(part, '\\S+') AS word, regexp_extract(part, '^\\s*') AS gap, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM pieces),
lists AS (SELECT doc_id, list(lower(nfc_normalize(word)) ORDER BY i) AS w FROM words GROUP BY doc_id),
units AS (SELECT doc_id, unnest(list_transform(range(len(w) - 49), lambda k: md5(array_to_string(w[k + 1:k + 50], ' ')))) AS unit, unnest(range(len(w) - 49)) AS i FROM lists WHERE len(w) >= 50),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id, i) AS k FROM units) WHERE k > 1),
marked AS (SELECT w.*, max(l.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS cut FROM words w LEFT JOIN later l ON l.doc_id = w.doc_id AND l.i = w.i),
edged AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens, cut AND NOT coalesce(lead(cut) OVER (PARTITION BY doc_id ORDER BY i), false) AS closes FROM marked),
spans AS (SELECT doc_id, i, e - length(word) AS beg, min(CASE WHEN closes THEN e END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fin, opens FROM edged),
lost AS (SELECT doc_id, count(*)::INT AS n_removed, sum(fin - beg)::INT AS chars_removed, string_agg((beg::BIGINT)::VARCHAR || '-' || (fin::BIGINT)::VARCHAR, ',' ORDER BY i) AS removed_spans FROM spans WHERE opens GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(CASE WHEN opens THEN gap WHEN cut THEN '' ELSE gap || word END, '' ORDER BY i) AS t FROM edged GROUP BY doc_id),
done AS (SELECT r.doc_id, n_removed, chars_removed, removed_spans, CASE WHEN n_removed IS NULL THEN text ELSE t || regexp_extract(text, '\\s*$') END AS cleaned
    FROM raw r LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id))
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(chars_removed, 0) AS chars_removed, coalesce(removed_spans, '') AS removed_spans, length(cleaned) AS n_chars, sha256(cleaned) AS text_sha256 FROM done
""",
    "op4_line_dedup": f"""
WITH {_UNITS},
solid AS (SELECT doc_id, pos, trim(line) AS unit, len(string_split(regexp_replace(trim(line), '\\s+', ' ', 'g'), ' ')) AS words FROM units WHERE solid),
often AS (SELECT *, dense_rank() OVER (ORDER BY unit) AS id, count(*) OVER (PARTITION BY unit) AS n FROM solid QUALIFY n > 1),
met AS (SELECT a.doc_id, a.pos, a.words, b.doc_id AS src, a.pos - b.pos AS shift FROM often a JOIN often b ON a.id = b.id AND (b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.pos < a.pos)),
runs AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, src, shift ORDER BY pos) AS run FROM met),
gone AS (SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, pos, sum(words) OVER (PARTITION BY doc_id, src, shift, run) AS total FROM runs) WHERE total >= 5),
{_CLEANED}
SELECT doc_id, n_removed, chars_removed, removed_spans, length(cleaned) AS n_chars, sha256(cleaned) AS text_sha256 FROM done
""",
    "op6_exact_dedup": """
WITH folded AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM folded
""",
    "op9_jaccard_join": """
WITH RECURSIVE tokens AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x09-\\x0D]', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
shingles AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM tokens),
sizes AS (SELECT doc_id, count(*) AS n, bit_xor(hash(s)) AS k1, sum(hash(s)::HUGEINT) AS k2 FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE i / (x.n + y.n - i) >= 0.8),
mutual AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, mutual.b FROM reach JOIN mutual ON reach.r = mutual.a),
classes AS (SELECT doc_id, min(r) AS class_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, class_id, coalesce(l.n, 0)::BIGINT AS n_links, coalesce(min(c.doc_id) OVER (PARTITION BY s.n, k1, k2, s.n IS NULL, CASE WHEN s.n IS NULL THEN c.doc_id END), c.doc_id) AS set_id
FROM classes c LEFT JOIN sizes s ON s.doc_id = c.doc_id LEFT JOIN (SELECT a, count(*) AS n FROM mutual GROUP BY a) l ON l.a = c.doc_id
""",
    "op12_prefix_trie": f"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
marked AS (SELECT *, left(sha256(length(role)::VARCHAR || ':' || role || text), 32) AS k, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w FROM given),
own AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, role, k) AS ks, list(w ORDER BY turn NULLS FIRST, role, k) AS ws, {_crc("conv_id::VARCHAR")} % 4 AS h FROM marked GROUP BY conv_id),
rebuilt AS (SELECT a.conv_id, list_concat(coalesce(b.ks[1:a.h], []), a.ks[a.h + 1:]) AS ks, list_concat(coalesce(b.ws[1:a.h], []), a.ws[a.h + 1:]) AS ws
    FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
members AS (SELECT conv_id, len(ks) AS n, ks, ws, unnest(range(len(ks) + 1)) AS d FROM rebuilt),
paths AS (SELECT conv_id, n, d, array_to_string(ks[1:d], '') AS path, CASE WHEN d > 0 THEN array_to_string(ks[1:d - 1], '') END AS up, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w FROM members),
nodes AS (SELECT path, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM paths GROUP BY path),
kids AS (SELECT up, count(*) AS n FROM nodes GROUP BY up),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.path),
tops AS (SELECT *, unnest(range(depth + 1)) AS k FROM full_nodes),
sums AS (SELECT left(path, 32 * k) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w)::BIGINT AS saved_tokens FROM tops GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums ON sums.path = f.path LEFT JOIN nodes p ON p.path = f.up
""",
    "op13_structure_repair": f"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS hit FROM conversations),
hurt AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE hit WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM given),
placed AS (SELECT *, row_number() OVER w AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, left(role, 1) AS z,
    lag(left(role, 1)) OVER w AS z0, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last
    FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(sha256(text), 32), copy)),
faults AS (SELECT *, CASE WHEN last = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM placed),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (z0 IS NOT NULL AND z0 || z NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
-- cheapest (cost, audit) from each row on, in the states nothing yet, after s, after u, after a
togo AS (SELECT conv_id, n AS i, {{'c': 0, 's': ''}} AS v1, {{'c': 10, 's': 'II'}} AS v2, {{'c': 5, 's': 'I'}} AS v3, {{'c': 0, 's': ''}} AS v4 FROM counts
    UNION ALL
    SELECT conv_id, i - 1, list_min([w1, {{'c': w3.c + 5, 's': 'I' || w3.s}}, {{'c': w4.c + 10, 's': 'II' || w4.s}}]), list_min([w2, {{'c': w3.c + 5, 's': 'I' || w3.s}}, {{'c': w4.c + 10, 's': 'II' || w4.s}}]),
        list_min([w3, {{'c': w4.c + 5, 's': 'I' || w4.s}}, {{'c': w3.c + 10, 's': 'II' || w3.s}}]), list_min([w4, {{'c': w3.c + 5, 's': 'I' || w3.s}}, {{'c': w4.c + 10, 's': 'II' || w4.s}}])
    FROM (SELECT conv_id, i,
        list_min([{{'c': v1.c + 2, 's': 'D' || v1.s}}, {{'c': v3.c + 1 + e, 's': 'R' || v3.s}}, {{'c': CASE z WHEN 's' THEN v2.c + e WHEN 'u' THEN v3.c + e ELSE 9999999 END, 's': 'K' || CASE z WHEN 's' THEN v2.s ELSE v3.s END}}]) AS w1,
        list_min([{{'c': v2.c + 2, 's': 'D' || v2.s}}, {{'c': v3.c + 1 + e, 's': 'R' || v3.s}}, {{'c': CASE WHEN z = 'u' THEN v3.c + e ELSE 9999999 END, 's': 'K' || v3.s}}]) AS w2,
        list_min([{{'c': v3.c + 2, 's': 'D' || v3.s}}, {{'c': v4.c + 1 + e, 's': 'R' || v4.s}}, {{'c': CASE WHEN z = 'a' THEN v4.c + e ELSE 9999999 END, 's': 'K' || v4.s}}]) AS w3,
        list_min([{{'c': v4.c + 2, 's': 'D' || v4.s}}, {{'c': v3.c + 1 + e, 's': 'R' || v3.s}}, {{'c': CASE WHEN z = 'u' THEN v3.c + e ELSE 9999999 END, 's': 'K' || v3.s}}]) AS w4
        FROM togo JOIN (SELECT conv_id AS cid, pos, z, CASE fault WHEN '' THEN 0 WHEN 't' THEN 5 ELSE 999999 END AS e FROM faults) f ON cid IS NOT DISTINCT FROM conv_id AND pos = i)),
best AS (SELECT conv_id, v1.c AS cost, v1.s AS audit FROM togo WHERE i = 0),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, unnest(range(len(audit))) AS j FROM best),
met AS (SELECT *, count(*) FILTER (e <> 'I') OVER o AS pos, count(*) FILTER (e <> 'D') OVER o AS made FROM letters WINDOW o AS (PARTITION BY conv_id ORDER BY j)),
told AS (SELECT m.conv_id, j, e, made, f.role, CASE WHEN e = 'I' THEN '' ELSE f.text END AS text, max(made = 1 AND e = 'K' AND f.z = 's') OVER (PARTITION BY m.conv_id) AS opens
    FROM met m LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.pos = m.pos),
lines AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (made - opens::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS t FROM told WHERE e <> 'D' GROUP BY conv_id)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM g.conv_id
""",
}
#: Bands of fingerprints find the links that the join finds.
ORACLES["near_links_of_documents"] = f"SELECT doc_id, class_id, n_links FROM ({ORACLES['op9_jaccard_join']})"
