"""DuckDB SQL for the corpus queries that SQL can state."""

from __future__ import annotations

from pitlane.llm.license_texts import LICENSES
from pitlane.llm.licenses import RULES as LICENSE_RULES
from pitlane.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    list_filter(string_split(translate(regexp_replace(lower(t), '[\x09-\x0D]', ' ', 'g'), '.,;:!?', ''), ' '),
                lambda x: x IN ({_STOP})) AS stops
  FROM d
), win AS (
  SELECT rid, i, list_slice(words, i, i + 7) AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(range(i, i + 8)) AS p
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
  ) GROUP BY rid
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - coalesce(list_unique(lines), 0))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(lines) AS n_lines, len(stops) AS n_stop,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha,
    len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ell,
    len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•·–]\s'))) AS n_bul
  FROM w LEFT JOIN rep USING (rid)
), v AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    list_filter([
      CASE WHEN n_words < 20 THEN 'n_words' END,
      CASE WHEN n_words > 0 AND n_repeat_words / n_words > 0.30 THEN 'repeat_word_ratio' END,
      CASE WHEN n_words = 0 OR word_chars / n_words < 2.0 OR word_chars / n_words > 14.0 THEN 'mean_word_chars' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.10 THEN 'symbol_ratio' END,
      CASE WHEN n_words = 0 OR n_stop / n_words < 0.02 THEN 'stop_word_ratio' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.35 THEN 'dup_line_ratio' END,
      CASE WHEN word_chars > 0 AND n_upper / word_chars > 0.40 THEN 'upper_ratio' END,
      CASE WHEN n_words = 0 OR n_alpha / n_words < 0.70 THEN 'alpha_word_ratio' END,
      CASE WHEN n_lines > 0 AND n_ell / n_lines > 0.30 THEN 'ellipsis_line_ratio' END,
      CASE WHEN n_lines > 0 AND n_bul / n_lines > 0.90 THEN 'bullet_line_ratio' END
    ], lambda x: x IS NOT NULL) AS b
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  array_to_string(b, ',') AS broken, NOT base_failed AND len(b) = 0 AS kept
FROM v
"""


def _sql_canonical(column: str) -> str:
    out = f"lower({column})"
    for pattern, new in LICENSE_RULES:
        new = new.replace("$1", r"\1").replace("$2", r"\2")
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
    return out


_KNOWN = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in LICENSES)

OP8 = f"""
WITH known AS (
  SELECT DISTINCT license_id, array_to_string(list_filter(string_split({_sql_canonical('t')}, chr(10)), lambda x: x <> ''), ' ') AS form
  FROM (VALUES {_KNOWN}) AS v(license_id, t)
), d AS (
  SELECT doc_id, list_filter(string_split({_sql_canonical('text')}, chr(10)), lambda x: x <> '') AS lines FROM documents
), u AS (
  SELECT doc_id, true AS whole, array_to_string(lines, ' ') AS form FROM d WHERE len(lines) > 0
  UNION ALL
  SELECT doc_id, false, unnest(lines) FROM d WHERE len(lines) > 1
)
SELECT doc_id, license_id, bool_or(whole) AS whole, count(*) AS n_units
FROM u JOIN known USING (form) WHERE form <> '' GROUP BY ALL
"""

#: crc32 of a string's UTF-8 bytes: the table of the reflected polynomial, then a fold over the bytes.
_CRC_TABLE = """
SELECT list(v ORDER BY i) AS tab FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) AS r(i)
)"""


def _crc32(text: str) -> str:
    """The checksum of a text expression, beside a relation with the table ``tab``."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


OP12 = f"""
WITH crc AS MATERIALIZED ({_CRC_TABLE}), d AS MATERIALIZED (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, crc
), c AS (
  SELECT *, sum(size) OVER (o ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total, row_number() OVER o AS n
  FROM d WINDOW o AS (ORDER BY doc_id NULLS FIRST, text_crc32, size)
), s AS (
  SELECT *, least(15, (2 * before + size) * 16 // (2 * total))::INTEGER AS shard FROM c
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY n) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM s
"""

# Row by row over each conversation, for each of four states (nothing yet, after s, u, a) the cheapest
# edits so far, the ASCII-least of equals, with the repaired rows.
_FAR11 = "{'cost': 1000000000, 'audit': '', 'rows': ''}"


def _with11(state: str, cost: str, letter: str, line: str = "''") -> str:
    return f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || {letter}, 'rows': {state}.rows || {line}}}"


def _insert11(state: str, role: str) -> str:
    return _with11(state, "5", "'I'", f"chr(10) || '{role}:'")


_GO11 = [_with11(f"p{k}", "2", "'D'") for k in range(4)]
_STAY11 = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"


def _move11(state: str, initial: str, role: str) -> str:
    """Keep or rerole the row from a state to a role; neither if it must go."""
    kept = _with11(state, _STAY11, "'K'", "chr(10) || role || ':' || text")
    changed = _with11(state, f"1 + {_STAY11}", "'R'", f"chr(10) || '{role}:' || text")
    must_go = "fault IN ('blank', 'duplicate')"
    return f"CASE WHEN {must_go} OR left(role, 1) <> '{initial}' THEN {_FAR11} ELSE {kept} END, CASE WHEN {must_go} THEN {_FAR11} ELSE {changed} END"


OP11 = f"""
WITH RECURSIVE crc AS MATERIALIZED ({_CRC_TABLE}), source AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crc
), damaged AS MATERIALIZED (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM source, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(length(role)::VARCHAR || ':' || role || text)) AS i,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last
  FROM damaged
), faulty AS MATERIALIZED (
  SELECT *, CASE WHEN last = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS neighbours
  FROM placed
), walk AS (
  SELECT DISTINCT conv_id, 0 AS i, {{'cost': 0, 'audit': '', 'rows': ''}} AS s0, {_FAR11} AS s1, {_FAR11} AS s2, {_FAR11} AS s3 FROM faulty
  UNION ALL
  SELECT conv_id, i, list_min([{_GO11[0]}]), list_min([{_GO11[1]}, {_move11("p0", "s", "system").split(", CASE")[0]}]),
    list_min([{_GO11[2]}, {_move11("p0", "u", "user")}, {_move11("p1", "u", "user")}, {_move11("p3", "u", "user")}]),
    list_min([{_GO11[3]}, {_move11("p2", "a", "assistant")}])
  FROM (
    SELECT q.*, list_min([p3_, {_insert11("p2", "assistant")}]) AS p3
    FROM (
      SELECT f.conv_id, f.i, f.role, f.text, f.fault, w.s0 AS p0, w.s1 AS p1, w.s3 AS p3_,
        list_min([w.s2, {_insert11("w.s0", "user")}, {_insert11("w.s1", "user")}, {_insert11("w.s3", "user")}]) AS p2
      FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    ) q
  )
), ended AS (
  SELECT conv_id, list_min([s0, s3, {_insert11("s2", "assistant")}, {_with11("s1", "10", "'II'", "chr(10) || 'user:' || chr(10) || 'assistant:'")}]) AS best
  FROM walk QUALIFY i = max(i) OVER (PARTITION BY conv_id)
), counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.rows, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
"""
