"""SQL of the registered queries, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import chat_windows, line_rules
from tidemark.llm.line_rules import LineRules

WORD = r"[^\x20\x09-\x0D]+"
_R = LineRules()


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _words_like(pattern: str) -> str:
    return f"len(list_filter(words, lambda x: regexp_matches(x, {_text(pattern)})))"


VECTOR_SEARCH = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1]::HUGEINT * p[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

QUALITY_RULES = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - {line_rules.REPEAT_WIDTH - 2})) AS p FROM docs),
windows AS (SELECT doc_id, p, array_to_string(words[p:p + {line_rules.REPEAT_WIDTH - 1}], ' ') AS w FROM places),
twice AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows),
repeated AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest(range(p, p + {line_rules.REPEAT_WIDTH})) AS q FROM twice WHERE n > 1) GROUP BY doc_id),
cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
lines AS (SELECT doc_id, line, regexp_extract_all(line, '{WORD}') AS words FROM cut),
counted AS (
  SELECT doc_id, line, len(words) AS n,
    NOT (regexp_matches(line, {_text(line_rules.ENDS)}) OR regexp_matches(line, {_text(line_rules.SENTENCE)}))
      OR {_words_like(line_rules.MARKS)} > {_R.marks_share} * len(words)
      OR ({_words_like(line_rules.SEPARATOR)} >= {_R.separators} AND {_words_like(line_rules.SEPARATOR)} >= {_R.separator_share} * len(words))
      OR (len(words) <= {_R.short_line} AND (regexp_matches(line, {_text(line_rules.NAVIGATION)}) OR regexp_matches(line, {_text(line_rules.BOILERPLATE)})))
      OR {_words_like(line_rules.SYMBOL)} > {_R.symbol_share} * len(words) AS fails
  FROM lines WHERE len(words) > 0),
by_doc AS (
  SELECT doc_id, sum(CASE WHEN fails THEN 0 ELSE n END) AS left_words, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM counted GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(d.words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(d.words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(b.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    coalesce(b.left_words, 0) AS left_words
  FROM docs d LEFT JOIN by_doc b USING (doc_id) LEFT JOIN repeated r USING (doc_id)),
judged AS (SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeated_percent} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - left_words <= {_R.max_lost} * n_words AS kept
FROM judged
"""

SOURCE_MIX = rf"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS most,
    ([3, 1, 2])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM totals),
-- Sources fill up in order of the level that fills them.
levels AS (
  SELECT *, coalesce(sum(most) OVER filled, 0) AS full_words, sum(weight) OVER rest AS free_weight,
    1.5::DOUBLE * sum(source_size) OVER () AS budget
  FROM weighted
  WINDOW filled AS (ORDER BY most / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY most / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT arg_min((budget - full_words) / free_weight, most / weight) AS level FROM levels
  WHERE (budget - full_words) / free_weight <= most / weight),
rated AS (
  SELECT source, source_size, least(most, level * weight) AS target,
    coalesce(floor(least(most, level * weight) / nullif(source_size, 0)), 0) AS certain
  FROM weighted, level),
ranked AS (
  SELECT s.doc_id, s.size, r.source, r.source_size, r.target, r.certain,
    coalesce(r.target / nullif(r.source_size, 0) - r.certain, 0) AS p,
    (('0x' || substr(md5('17|' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_before
  FROM ranked)
SELECT doc_id, size, source_size, target,
  (size * (certain + CASE WHEN p > 0 AND 2 * words_before + size <= 2 * (target - certain * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS p FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT o.a, o.b FROM shared o JOIN sizes x ON x.doc_id = o.a JOIN sizes y ON y.doc_id = o.b
  WHERE 100 * o.n >= 85 * (x.n + y.n - o.n)),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id
"""

_TURN_CHARS = len(chat_windows.START) + len(chat_windows.END) + 2
CHAT_WINDOWS = rf"""
WITH said AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, i, (['user', 'assistant'])[i + 1], '<|im_end|><|im_start|>assistant ok' FROM range(2) t(i)),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS seq,
    count(*) OVER (PARTITION BY conv_id) AS n FROM said),
sized AS (
  SELECT *, len(regexp_extract_all(text, '{WORD}')) + {chat_windows.TURN_TOKENS} AS tokens,
    {_TURN_CHARS} + length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'), chr(10), chr(92) || chr(10)))
      + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')) AS chars,
    seq = 1 AND role = 'system' AND n > 1 AS opens FROM turns),
systems AS (SELECT conv_id, tokens, chars FROM sized WHERE opens),
strides AS (
  SELECT s.conv_id, s.seq, s.tokens, s.chars, coalesce(y.chars, 0) AS system_chars,
    greatest({chat_windows.BUDGET // 4}, {chat_windows.BUDGET - chat_windows.HISTORY} - coalesce(y.tokens, 0)) AS stride,
    (sum(s.tokens) OVER (PARTITION BY s.conv_id ORDER BY s.seq))::BIGINT AS stop
  FROM sized s LEFT JOIN systems y ON s.conv_id IS NOT DISTINCT FROM y.conv_id WHERE NOT s.opens),
cells AS (
  SELECT *, stop - tokens AS start, 2 * ((stop - tokens) // stride) + ((stop - tokens) // stride <> (stop - 1) // stride)::INT AS cell FROM strides),
placed AS (
  SELECT *, coalesce(sum(chars) OVER (PARTITION BY conv_id ORDER BY start RANGE BETWEEN {chat_windows.HISTORY} PRECEDING AND 1 PRECEDING), 0) AS history_chars,
    row_number() OVER (PARTITION BY conv_id, cell ORDER BY seq) = 1 AS leads FROM cells),
written AS (
  SELECT conv_id, sum(chars + CASE WHEN leads THEN history_chars + system_chars ELSE 0 END)::BIGINT AS formatted_chars FROM placed GROUP BY conv_id),
whole AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY seq) FILTER (WHERE role = 'assistant'), '') AS loss FROM turns GROUP BY conv_id)
SELECT w.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM whole w JOIN written f ON w.conv_id IS NOT DISTINCT FROM f.conv_id
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    step = "list_reduce(list_prepend(xor(a, b), [0::UBIGINT for _ in range(8)]), lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)"
    codes = f"[ascii(c)::UBIGINT for c in string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda a, b: {step}), 4294967295::UBIGINT)"


def _record(*columns: str) -> str:
    return " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}, '-')" for c in columns)


def _levels(name: str, leaves: str) -> str:
    """Nodes of every level (``tree``, ``h``, ``i``, ``n``, ``digest``), and the texts of the siblings on either side."""
    run = "PARTITION BY tree, h, i // 16 ORDER BY i"
    return f"""
{name} AS (
  SELECT tree, 0 AS h, i, n, leaf AS digest FROM {leaves}
  UNION ALL
  SELECT tree, h + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY tree, h, i // 16),
{name}_sides AS (
  SELECT tree, h, i, n, digest,
    coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1)"""


def _walk(name: str, start: str, sides: str) -> str:
    """From each leaf up: the siblings so far and the digest that the shown leaf leads to."""
    return f"""
{name} AS (
  SELECT id, tree, 0 AS h, i, proof, found FROM {start}
  UNION ALL
  SELECT w.id, w.tree, w.h + 1, w.i // 16, w.proof || s.l || s.r, sha256(s.l || w.found || s.r)
  FROM {name} w JOIN {sides} s ON s.tree = w.tree AND s.h = w.h AND s.i = w.i),
{name}_done AS (SELECT id, tree, max_by(proof, h) AS proof, max_by(found, h) AS found FROM {name} GROUP BY id, tree)"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE records AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, sha256({_record("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({_record("doc_id", "source", "lang", "n_chars", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS shown
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS id,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM records),
{_levels("up", "leaves")},
tops AS (
  SELECT tree AS name, 'all' AS tree, digest AS leaf, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
{_levels("over", "tops")},
begin_low AS (SELECT id, tree, i, '' AS proof, coalesce(shown, leaf) AS found FROM leaves),
{_walk("low", "begin_low", "up_sides")},
begin_high AS (SELECT l.id, 'all' AS tree, t.i, l.proof, l.found FROM low_done l JOIN tops t ON t.name = l.tree),
{_walk("high", "begin_high", "over_sides")}
SELECT l.doc_id, l.leaf, t.leaf AS subroot, o.digest AS root, sha256(h.proof) AS proof_sha256, h.found AS folded_root, h.found = o.digest AS verified
FROM leaves l JOIN high_done h USING (id) JOIN tops t ON t.name = l.tree JOIN over o ON o.n = 1
"""

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM filled WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64), role, text) AS k FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS nth,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM placed),
judged AS (
  SELECT conv_id, turn, role, text, k, initial,
    CASE WHEN shown = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) AS previous FROM faulty),
inserts(p, q, cost, letters) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (3, 2, 3, 'I'), (2, 3, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')),
roles(initial, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
edits AS (
  SELECT j.conv_id, j.k, r.p, r.q, CASE WHEN j.initial = r.initial THEN 0 ELSE 3 END + CASE WHEN j.fault = 't' THEN 3 ELSE 0 END AS cost,
    CASE WHEN j.initial = r.initial THEN 'K' ELSE 'R' END AS letter
  FROM judged j JOIN roles r ON j.fault IN ('', 't') AND (j.initial = r.initial OR r.initial <> 's')
  UNION ALL SELECT conv_id, k, s.p, s.p, 4, 'D' FROM judged, (SELECT DISTINCT p FROM inserts) s),
best(conv_id, k, q, found) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, struct_pack(cost := 0, audit := '') FROM judged
  UNION ALL
  SELECT b.conv_id, b.k + 1, e.q, min(struct_pack(cost := b.found.cost + i.cost + e.cost, audit := b.found.audit || i.letters || e.letter))
  FROM best b JOIN inserts i ON i.p = b.q JOIN edits e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.k = b.k + 1 AND e.p = i.q GROUP BY b.conv_id, b.k + 1, e.q),
ends AS (
  SELECT b.conv_id, min(struct_pack(cost := b.found.cost + i.cost, audit := b.found.audit || i.letters)) AS found
  FROM best b JOIN inserts i ON i.p = b.q AND i.q IN (0, 3) JOIN (SELECT conv_id, max(k) AS k FROM judged GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM b.conv_id AND l.k = b.k
  GROUP BY b.conv_id),
letters AS (SELECT conv_id, unnest(string_split(found.audit, '')) AS letter, generate_subscripts(string_split(found.audit, ''), 1) AS place FROM ends WHERE found.audit <> ''),
counted AS (SELECT *, sum(CASE WHEN letter = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY place) AS k FROM letters),
left_over AS (
  SELECT c.conv_id, c.place, c.letter, j.role, j.initial, CASE WHEN c.letter = 'I' THEN '' ELSE j.text END AS text
  FROM counted c LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id AND j.k = c.k AND c.letter <> 'I' WHERE c.letter <> 'D'),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS m FROM left_over),
headed AS (SELECT *, coalesce(bool_or(m = 1 AND letter = 'K' AND initial = 's') OVER (PARTITION BY conv_id), false) AS system FROM numbered),
repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (m - system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY m)) AS hash
  FROM headed GROUP BY conv_id),
totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (k > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.found.cost, 0)::BIGINT AS cost, coalesce(e.found.audit, '') AS audit, coalesce(r.hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES: dict[str, str] = {
    "op1_vector_search": VECTOR_SEARCH,
    "op2_quality_rules": QUALITY_RULES,
    "op6_source_mix": SOURCE_MIX,
    "op8_jaccard_join": JACCARD_JOIN,
    "op10_chat_windows": CHAT_WINDOWS,
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op12_merkle_manifest": MERKLE_MANIFEST,
}
