"""DuckDB SQL for those queries of this package that SQL can express."""

WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OVERLAPS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0)),
spans AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM d, spans WHERE len(w) >= n),
hits AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, g)),
covered AS (SELECT r, count(DISTINCT p) AS hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS met, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit, 0) AS n_hit, coalesce(met, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit > 0 AND 20 * hit >= len(w), false) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

ESCAPED = r"""regexp_replace(replace({0}, '\', '\\'), '(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g')"""

CHAT = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, ceil(length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) / 4.0)
    + strlen(text) - length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) + 4 AS tokens,
    12 + length(replace({ESCAPED.format('role')}, chr(10), '\\' || chr(10))) + 1 + length({ESCAPED.format('text')}) + 11 AS chars
  FROM given),
summed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn, role, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized),
system AS (SELECT conv_id, tokens AS head, chars AS head_chars FROM summed WHERE start = 0 AND role = 'system'),
shares AS (
  SELECT s.*, s.start = 0 AND role = 'system' AS is_system, start - coalesce(head, 0) AS pos,
    floor(greatest(512, 1792 - coalesce(head, 0)) / 2) AS share, coalesce(head_chars, 0) AS head_chars
  FROM summed s LEFT JOIN system USING (conv_id)),
placed AS (SELECT *, greatest(0, floor(pos / share)) AS own FROM shares),
windows AS (
  SELECT conv_id, own, min(pos) AS first, bool_or(is_system) AS has_system, any_value(head_chars) AS head_chars
  FROM placed GROUP BY conv_id, own),
shown AS (
  SELECT conv_id, sum(chars) AS chars FROM placed GROUP BY conv_id
  UNION ALL SELECT p.conv_id, sum(p.chars) FROM placed p JOIN windows w ON w.conv_id = p.conv_id AND w.own = p.own + 1
    WHERE NOT p.is_system AND p.pos >= w.first - 256 GROUP BY p.conv_id
  UNION ALL SELECT conv_id, sum(head_chars) FROM windows WHERE NOT has_system GROUP BY conv_id),
sizes AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM shown GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  any_value(formatted_chars) AS formatted_chars
FROM given JOIN sizes USING (conv_id) GROUP BY conv_id
"""

RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
q AS (SELECT row_number() OVER () AS i, item_id, {WORDS} AS w FROM benchmark),
qt AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(w) AS term FROM q) GROUP BY i, term),
size AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM qt) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, size GROUP BY term, n),
spread AS (SELECT r, doc_id, 25 + (75 * len(w) * n) // l AS m FROM d, size WHERE len(w) > 0),
scores AS (
  SELECT i, r, any_value(doc_id) AS doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM tf JOIN weights USING (term) JOIN qt USING (term) JOIN spread USING (r) GROUP BY i, r),
ranks AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranks JOIN q USING (i) WHERE rank <= 10
"""

ORACLES = {"op2_winnowed_overlaps": OVERLAPS, "op6_chat_windows": CHAT, "op11_ranked_documents": RANKED}
