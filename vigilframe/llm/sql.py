"""SQL for DuckDB whose rows the registered queries of this subpackage must equal."""

from __future__ import annotations

_EXACT = r"""
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
  FROM documents
), g AS (
  SELECT normal, count(*) AS group_size, arg_min(doc_id, (-chars, doc_id)) AS keep_id FROM t GROUP BY normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256
FROM t JOIN g USING (normal)
"""

_MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS nth
  FROM d GROUP BY source
), a AS (
  SELECT *, source_size * 2.0::DOUBLE AS top,
         coalesce(sum(source_size * 2.0::DOUBLE) OVER o, 0) AS tops, coalesce(sum(w) OVER o, 0) AS ws,
         sum(source_size) OVER () * 1.5::DOUBLE AS wanted, sum(w) OVER () AS all_w
  FROM s WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (SELECT *, top * (all_w - ws) <= w * (wanted - tops) AS is_full FROM a
), r AS (
  SELECT *, wanted - sum(CASE WHEN is_full THEN top ELSE 0 END) OVER () AS rest,
         all_w - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER () AS open_w FROM f
), t AS (SELECT source, source_size, CASE WHEN is_full THEN top ELSE w * rest / open_w END AS target FROM r
), x AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
"""


_ESCAPED = r"""regexp_replace(regexp_replace({0}, '(<)(\\*)(\|turn\|>|\|text\|>|\|end\|>|s>|/s>)', '\1\\\2\3', 'g'),
  '(\[)(\\*)(INST\]|/INST\])', '\1\\\2\3', 'g')"""

_CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total,
         sum(length('<|turn|><|text|><|end|>') + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) OVER w AS so_far
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
), g AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '') AS loss,
         sum(so_far) FILTER (role = 'assistant' OR n = total) AS formatted_chars
  FROM o GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM g
"""


def _assigned(book: str) -> str:
    return f"""SELECT rid, part, v, min({{'d': list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': entry}}) AS best
  FROM pv JOIN {book} USING (part) GROUP BY rid, part, v"""


def _moved(book: str, assigned: str) -> str:
    return f"""SELECT part, entry, coalesce(m, c) AS c FROM {book} LEFT JOIN (
    SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS m FROM (
      SELECT part, best.e AS entry, place, sum(v[place])::BIGINT AS s, count(*) AS n
      FROM {assigned}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM pv) + 1)) AS place) GROUP BY ALL) GROUP BY part, entry
  ) USING (part, entry)"""


_CODES = f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pv AS (
  SELECT rid, part, w[part * (len(w) // 16) + 1:(part + 1) * (len(w) // 16)] AS v FROM k, (SELECT unnest(range(16)) AS part)
), b0 AS (SELECT part, rid - 1 AS entry, v AS c FROM pv WHERE rid <= 64
), a0 AS ({_assigned('b0')}), b1 AS ({_moved('b0', 'a0')}
), a1 AS ({_assigned('b1')}), b2 AS ({_moved('b1', 'a1')}
), a2 AS ({_assigned('b2')}
), e AS (
  SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a2 GROUP BY rid
), h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM k JOIN e USING (rid), h
"""


def _spent(way: str, cost: str, letter: str) -> str:
    """A way is its cost in six digits and its letters, so the least string is the best way."""
    return f"lpad((substr({way}, 1, 6)::INT + {cost})::VARCHAR, 6, '0') || substr({way}, 7) || '{letter}'"


_GOES = "(CASE WHEN p[i] = '-' THEN NULL ELSE ascii(p[i])::INT // 97 * -1 + 1 END)"
_STEP = {
    "w0": [_spent("w0", "3", "D")],
    "w1": [_spent("w1", "3", "D"), f"CASE WHEN lower(p[i]) = 's' THEN {_spent('w0', _GOES, 'K')} END"],
    "w2": [_spent("w2", "3", "D")] + [x for w in ("w0", "w1", "w3") for x in (
        f"CASE WHEN lower(p[i]) = 'u' THEN {_spent(w, _GOES, 'K')} END", _spent(w, _GOES + " + 2", "R"))],
    "w3": [_spent("w3", "3", "D"), f"CASE WHEN lower(p[i]) = 'a' THEN {_spent('w2', _GOES, 'K')} END", _spent("w2", _GOES + " + 2", "R")],
}
_STEPS = ", ".join(f"least({', '.join(options)}) AS {w}" for w, options in _STEP.items())
_WITH_U = f"least(w2, {', '.join(_spent(w, '2', 'I') for w in ('w0', 'w1', 'w3'))})"

_REPAIR = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS tbl
), c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda s: ord(s)::BIGINT)),
    lambda c, x: xor(c >> 8, tbl[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS code
  FROM conversations, crc
), d AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, (VALUES (1), (2)) copies(copy) WHERE code <> 0 AND (copy = 1 OR code = 3)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM d
), f AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault
  FROM n
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, list(role ORDER BY n) AS roles, list(text ORDER BY n) AS texts,
         string_agg(CASE WHEN fault IN ('blank', 'duplicate') THEN '-' WHEN fault = 'truncated' THEN upper(letter) ELSE letter END, '' ORDER BY n) AS p
  FROM (SELECT *, CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END AS letter FROM f) GROUP BY conv_id
), ways AS (
  SELECT conv_id, p, 1::BIGINT AS i, '000000' AS w0, NULL::VARCHAR AS w1, '000002I' AS w2, '000004II' AS w3 FROM g
  UNION ALL
  SELECT conv_id, p, i, w0, w1, w2, least(w3, {_spent('w2', '2', 'I')}) AS w3 FROM (
    SELECT conv_id, p, i, w0, w1, {_WITH_U} AS w2, w3 FROM (
      SELECT conv_id, p, i + 1 AS i, {_STEPS} FROM ways WHERE i <= length(p)))
), best AS (
  SELECT conv_id, substr(least(w0, w3), 1, 6)::BIGINT AS cost, substr(least(w0, w3), 7) AS audit FROM ways WHERE i = length(p) + 1
), edit AS (
  SELECT conv_id, k, audit[k] AS letter, k - len(regexp_replace(audit[:k], '[^I]', '', 'g')) AS nth,
         k - len(regexp_replace(audit[:k], '[^D]', '', 'g')) AS place
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)
), made AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN roles[nth] WHEN (place - first_s) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || CASE letter WHEN 'I' THEN '' ELSE texts[nth] END, chr(10) ORDER BY k)) AS repaired_sha256
  FROM edit JOIN g USING (conv_id) JOIN (
    SELECT conv_id, count(*) FILTER (letter = 'K' AND place = 1 AND left(roles[nth], 1) = 's') AS first_s FROM edit JOIN g USING (conv_id)
    WHERE letter <> 'D' GROUP BY conv_id) USING (conv_id)
  WHERE letter <> 'D' GROUP BY conv_id
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN g USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN made USING (conv_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": _EXACT, "op4_source_mix": _MIX, "op11_conversation_repair": _REPAIR, "op12_chat_examples": _CHAT,
        "op13_vector_codes": _CODES,
    }
