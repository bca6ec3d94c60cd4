"""DuckDB SQL of the queries that SQL can express: plain set logic, without sketches, signatures or sorted ranges."""

from __future__ import annotations

from .chat import CONTROL
from .quality import LONG_WORD, POLICIES, RULES

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
TEXT = "coalesce(text, '')"


def ascii_lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


OP4 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(ascii_lower(TEXT))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
          WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
          ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM linked UNION ALL SELECT v, u FROM linked),
reach(a, b) AS (SELECT u, v FROM both_ways UNION SELECT r.a, e.v FROM reach r JOIN both_ways e ON e.u = r.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, min(r.b)) AS component_id,
       d.doc_id = least(d.doc_id, min(r.b)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""

_BITS = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, (_, cond) in enumerate(RULES))
OP5 = f"""
WITH w AS (SELECT doc_id, {TEXT} AS text, {WORDS.format(TEXT)} AS ws, string_split({TEXT}, chr(10)) AS ls FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
k AS (SELECT doc_id, pos, word, word || ' ' || lead(word, 1) OVER d || ' ' || lead(word, 2) OVER d || ' ' || lead(word, 3) OVER d
             || ' ' || lead(word, 4) OVER d AS win FROM t WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
f AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS twice FROM k),
c AS (SELECT *, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM f),
r AS (SELECT doc_id, count(*) FILTER (covered) AS n_repeat_words, CAST(sum(length(word)) AS BIGINT) AS word_chars,
             count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\\x00-\\x7F]')) AS n_letter_words,
             count(*) FILTER (length(word) > {LONG_WORD}) AS n_long_words FROM c GROUP BY doc_id),
l AS (SELECT doc_id, unnest(ls) AS line FROM w),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(word_chars, 0) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
             coalesce(n_letter_words, 0) AS n_letter_words, coalesce(n_long_words, 0) AS n_long_words
      FROM w LEFT JOIN r USING (doc_id) LEFT JOIN dup USING (doc_id)),
b AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & {POLICIES['v1']}) <> 0 AS base_failed,
       (failed_bits & {POLICIES['v3'] | POLICIES['v1']}) = 0 AS kept, failed_bits, n_lines, n_letter_words, n_long_words FROM b
"""

_RAW = rf"([<\[])(\\*)({CONTROL})"
OP7 = f"""
WITH c AS (SELECT conv_id, turn, role, {TEXT} AS text FROM conversations
           UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
             sum(length(regexp_replace(text, '{_RAW}', '\\1\\2\\\\\\3', 'g'))
                 + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 13 END) + 3 AS chars
      FROM c GROUP BY conv_id)
SELECT CAST(conv_id AS BIGINT) AS conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g
"""

OP9 = f"""
WITH w AS (SELECT doc_id, {WORDS.format(TEXT)} AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
k AS (SELECT doc_id, pos, md5(array_to_string(ws[pos:pos + 19], ' ')) AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS pos FROM w WHERE len(ws) >= 20)),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1 AS later FROM k),
m AS (SELECT t.doc_id, t.pos, word, coalesce(bool_or(later) OVER (PARTITION BY t.doc_id ORDER BY t.pos
             ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone FROM t LEFT JOIN f ON f.doc_id = t.doc_id AND f.pos = t.pos),
g AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
             string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN g USING (doc_id)
"""

OP10 = rf"""
WITH l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
           FROM (SELECT doc_id, string_split({TEXT}, chr(10)) AS ls FROM documents)),
k AS (SELECT *, {ascii_lower(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key FROM l),
often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""

OP12 = f"""
WITH d AS (SELECT doc_id, {ascii_lower(TEXT)} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

OP13 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_dot_product(a.e, v.e) AS BIGINT) AS score
      FROM v a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s
      WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3
"""

ORACLE = {
    "op4_minhash_near_dedup": OP4,
    "op5_quality_rules": OP5,
    "op7_chat_format": OP7,
    "op9_substring_dedup": OP9,
    "op10_line_dedup": OP10,
    "op12_exact_dedup": OP12,
    "op13_hard_negatives": OP13,
}
