"""SQL (DuckDB) for the queries that SQL can express, written on the given tables."""

from __future__ import annotations

from tideline.llm.chat import CONTROLS, END, MIDDLE, START
from tideline.llm.ownership import ACCESS, ASSIGN, HEX, KINDS, OPAQUE

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def found_sql(kind: str, pattern: str, keep: str = "true") -> str:
    """Matches of one kind with their places: lengths of the texts between and of earlier matches."""
    value = f"regexp_extract(hits[i], {quoted(pattern)}, 2)" if kind == "assign" else "hits[i]"
    return f"""SELECT * FROM (
  SELECT row, '{kind}' AS kind, {KINDS.index(kind)} AS rank, length(hits[i]) AS size, {value} AS value,
    list_sum([length(g) FOR g IN gaps[1:i]]) + coalesce(list_sum([length(h) FOR h IN hits[1:i - 1]]), 0) AS start
  FROM (SELECT row, regexp_extract_all(text, {quoted(pattern)}) AS hits,
      string_split_regex(text, {quoted(pattern)}) AS gaps FROM docs), unnest(range(1, len(hits) + 1)) AS t(i))
WHERE {keep}"""


OPAQUE_KEPT = "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= 10"

SECRETS = f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
base AS ({found_sql('assign', ASSIGN, 'length(value) >= 8')}
UNION ALL {found_sql('access', ACCESS)}
UNION ALL {found_sql('hex', HEX)}),
opaque AS (SELECT * FROM ({found_sql('opaque', OPAQUE, OPAQUE_KEPT)}) o WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.row = o.row AND b.start < o.start + o.size AND o.start < b.start + b.size)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM opaque),
owned AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners FROM spans JOIN docs USING (row) GROUP BY 1),
shown AS (SELECT s.*, owners <= 2 AS live, concat_ws(':', kind, start::BIGINT, (start + size)::BIGINT) AS span
  FROM spans s JOIN owned USING (value) WHERE kind <> 'opaque' OR owners <= 2),
per AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, rank) FILTER (kind <> 'opaque') AS base,
    string_agg(span, ',' ORDER BY start, rank) AS spans, count(*) FILTER (live) AS n_live
  FROM shown GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM docs LEFT JOIN per USING (row)"""


def escaped_length(column: str) -> str:
    """Every control string, however many backslashes it has already, gets one more character."""
    rests = "|".join(c[1:].replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for c in CONTROLS)
    return rf"(length({column}) + len(regexp_extract_all({column}, '[<\[]\\*(?:{rests})')))"


TAGS = len(START + MIDDLE + END)
CHATS = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
per AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS shown,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS learned,
    sum({TAGS} + {escaped_length('role')} + {escaped_length('text')})::BIGINT AS formatted_chars
  FROM turns GROUP BY 1)
SELECT conv_id, n_turns, sha256(shown) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars FROM per"""

WORDS = rf"""regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
CONTAMINATION = f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {WORDS} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, words[i:i + least(10, len(words)) - 1] AS w
  FROM items, unnest(range(1, greatest(len(words) - 8, 2))) AS t(i) WHERE len(words) > 0),
lengths AS (SELECT DISTINCT len(w) AS n FROM windows),
grams AS (
  SELECT row, i, n, words[i:i + n - 1] AS w FROM docs, lengths, unnest(range(1, greatest(len(words) - n + 2, 1))) AS t(i)),
hits AS (SELECT row, i, n, item FROM grams JOIN windows USING (w)),
covered AS (SELECT row, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY 1),
named AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM hits) GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN named USING (row)"""

def near_sql(size: int, percent: int, result: str) -> str:
    """Components of documents by their distinct shingles of ``size`` words."""
    return rf"""WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, words[i:i + least({size}, len(words)) - 1] AS g
  FROM docs, unnest(range(1, greatest(len(words) - {size - 2}, 2))) AS t(i) WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * shared >= {percent} * (a.n + b.n - shared)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM docs UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT x AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id{result}
FROM reach LEFT JOIN sizes ON doc_id = x GROUP BY x"""


NEAR = near_sql(5, 75, ", x = min(y) AS kept")
SIMILAR = near_sql(3, 90, "")



def crc32_sql(text: str) -> str:
    """crc32 of an ASCII text, bit by bit; null for null."""
    step = "lambda v, bit: xor(v >> 1, (v & 1) * 3988292384)"
    byte = f"lambda crc, b: list_reduce([xor(crc, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], {step})"
    return f"xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split({text}, '')], {byte}), 4294967295)"


def field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(map(field_sql, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


MANIFEST = f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, source, leaf, CASE WHEN tampered THEN small ELSE leaf END AS changed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM (SELECT doc_id, source, crc % 5 = 0 AS tampered, {leaf_sql('text')} AS leaf,
      {leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} AS small
    FROM (SELECT *, {crc32_sql('doc_id::VARCHAR')} AS crc FROM documents))),
low AS (
  SELECT source, 0 AS level, i, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 16, sha256(string_agg(node, '' ORDER BY i)), (max(n) + 15) // 16
  FROM low WHERE n > 1 GROUP BY source, level, i // 16),
subroots AS (SELECT source, node AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, place AS i, subroot AS node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(node, '' ORDER BY i)), (max(n) + 15) // 16
  FROM high WHERE n > 1 GROUP BY level, i // 16),
path AS (SELECT row_number() OVER () AS row, doc_id, leaf, changed, l.i, l.source, subroot, height, place,
    (SELECT node FROM high WHERE n = 1) AS root, (SELECT level FROM high WHERE n = 1) AS top
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
steps AS (
  SELECT row, level, i >> (4 * level)::INTEGER AS spot, source, true AS below FROM path, unnest(range(0, height)) AS t(level)
  UNION ALL
  SELECT row, height + level, place >> (4 * level)::INTEGER, source, false FROM path, unnest(range(0, top)) AS t(level)),
met AS (
  SELECT row, s.level, s.spot, l.i, l.node FROM steps s JOIN low l
    ON s.below AND l.source IS NOT DISTINCT FROM s.source AND l.level = s.level AND l.i // 16 = s.spot // 16 AND l.i <> s.spot
  UNION ALL
  SELECT s.row, s.level, s.spot, h.i, h.node FROM steps s JOIN path p ON p.row = s.row JOIN high h
    ON NOT s.below AND h.level = s.level - p.height AND h.i // 16 = s.spot // 16 AND h.i <> s.spot),
sides AS (
  SELECT row, level, coalesce(string_agg(node, '' ORDER BY i) FILTER (i < spot), '') AS lefts,
    coalesce(string_agg(node, '' ORDER BY i) FILTER (i > spot), '') AS rights
  FROM met GROUP BY row, level),
fold AS (
  SELECT row, 0 AS level, changed AS node FROM path
  UNION ALL
  SELECT f.row, f.level + 1, sha256(coalesce(lefts, '') || f.node || coalesce(rights, ''))
  FROM fold f JOIN path p ON p.row = f.row LEFT JOIN sides s ON s.row = f.row AND s.level = f.level
  WHERE f.level < p.height + p.top),
proofs AS (SELECT row, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof FROM sides GROUP BY row)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, node AS folded_root, node = root AS verified
FROM path p JOIN fold f ON f.row = p.row AND f.level = p.height + p.top LEFT JOIN proofs q ON q.row = p.row"""

#: Cost and audit as one text that sorts by cost, then audit.
NONE = "'900000000'"


def edited(rest: str, cost: str, letter: str) -> str:
    return f"lpad((left({rest}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letter}' || substr({rest}, 10)"


def plain_sql(state: int, kept: dict[str, int], wanted: int) -> str:
    """The best of deleting, keeping or reroling a row, seen from a state of the grammar."""
    keep = " ".join(f"WHEN '{c}' THEN {edited(f'g{to}', 'extra', 'K')}" for c, to in kept.items())
    role = f"CASE WHEN sym = 'x' THEN {NONE} ELSE {edited(f'g{wanted}', '3 + extra', 'R')} END"
    return f"least({edited(f'g{state}', '4', 'D')}, {role}, CASE lower(sym) {keep} ELSE {NONE} END) AS p{state}"


REPAIR = f"""WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS fault FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM turns, unnest(range(0, CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS k,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS filled
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN filled = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
      WHEN right(filled, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair
  FROM placed),
signed AS (
  SELECT conv_id, k, role, text,
    CASE fault WHEN '' THEN initial WHEN 'truncated' THEN upper(initial) ELSE 'x' END AS sym,
    CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM faulty),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY 1),
steps AS (
  SELECT conv_id, n + 1 AS k, '000000000' AS g0, '000000006II' AS g1, '000000003I' AS g2, '000000000' AS g3 FROM counts
  UNION ALL
  SELECT conv_id, k, least(p0, {edited(f"least(p2, {edited('p3', '3', 'I')})", '3', 'I')}),
    least(p1, {edited(f"least(p2, {edited('p3', '3', 'I')})", '3', 'I')}),
    least(p2, {edited('p3', '3', 'I')}), least(p3, {edited('p2', '3', 'I')})
  FROM (SELECT s.conv_id, s.k, {plain_sql(0, {'s': 1, 'u': 2}, 2)}, {plain_sql(1, {'u': 2}, 2)},
      {plain_sql(2, {'a': 3}, 3)}, {plain_sql(3, {'u': 2}, 2)}
    FROM steps t JOIN signed s ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND s.k = t.k - 1)),
audits AS (SELECT conv_id, left(g0, 9)::BIGINT AS cost, substr(g0, 10) AS audit FROM steps WHERE k = 1),
edits AS (
  SELECT conv_id, i, audit[i] AS edit, i - len(regexp_extract_all(audit[1:i], 'I')) AS k,
    i - len(regexp_extract_all(audit[1:i], 'D')) AS place
  FROM audits, unnest(range(1, len(audit) + 1)) AS t(i)),
lines AS (
  SELECT e.conv_id, i, edit, place, role, text,
    bool_or(place = 1 AND edit = 'K' AND left(role, 1) = 's') OVER (PARTITION BY e.conv_id) AS system_first
  FROM edits e LEFT JOIN signed s ON edit <> 'I' AND s.conv_id IS NOT DISTINCT FROM e.conv_id AND s.k = e.k WHERE edit <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE wanted END || ':' ||
    CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS body
  FROM (SELECT *, CASE WHEN (place + system_first::BIGINT) % 2 = 1 THEN 'user' ELSE 'assistant' END AS wanted FROM lines) GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLE = {
    "op13_size_aware_join": SIMILAR,
    "op11_suffix_repair": REPAIR,
    "op12_merkle_manifest": MANIFEST,
    "op1_secret_ownership": SECRETS,
    "op7_chat_events": CHATS,
    "op8_hyperminhash": NEAR,
    "op9_fm_decontamination": CONTAMINATION,
}
