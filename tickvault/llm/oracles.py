"""DuckDB SQL of the training-data queries that SQL can express."""

CHAT = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, role, unnest(l) AS line, generate_subscripts(l, 1) AS i
  FROM (SELECT conv_id, turn, role, string_split(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(10)) AS l FROM conversations)),
marked AS (SELECT *, regexp_extract(line, '^[ \t]*(?:>[ \t]*)*') AS marks FROM raw),
leveled AS (
  SELECT conv_id, turn, role, i, length(regexp_replace(marks, '[^>]', '', 'g')) AS level,
         CASE WHEN contains(marks, '>') THEN substr(line, length(marks) + 1) ELSE line END AS line FROM marked),
kept AS (
  SELECT * FROM (SELECT *, lead(level) OVER (PARTITION BY conv_id, turn ORDER BY i) AS following FROM leveled)
  WHERE NOT (level = 0 AND coalesce(following, 0) > 0
             AND regexp_matches(trim(line), '^(on|am|le|el)\b.{0,200}\b(wrote|schrieb|a écrit|escribió)\s?:$', 'i'))),
stretches AS (
  SELECT *, sum(CAST(level IS DISTINCT FROM before AS INTEGER)) OVER (PARTITION BY conv_id, turn ORDER BY i) AS stretch
  FROM (SELECT *, lag(level) OVER (PARTITION BY conv_id, turn ORDER BY i) AS before FROM kept)),
texts AS (
  SELECT conv_id, turn, level, string_agg(line, ' ' ORDER BY i) AS s FROM kept GROUP BY conv_id, turn, level
  UNION ALL
  SELECT conv_id, turn, level, string_agg(line, ' ' ORDER BY i) FROM stretches WHERE level > 0 GROUP BY conv_id, turn, level, stretch),
passages AS (
  SELECT conv_id, turn, level, line AS s FROM kept
  UNION ALL SELECT conv_id, turn, level, s FROM texts
  UNION ALL SELECT conv_id, turn, level, unnest(regexp_split_to_array(s, '[.!?…。！？]+')) FROM texts),
keys AS (
  SELECT * FROM (SELECT DISTINCT conv_id, turn, level, trim(regexp_replace(lower(s), '[^\p{L}\p{N}]+', ' ', 'g')) AS s FROM passages) WHERE s <> ''),
said AS (SELECT conv_id, s, min(turn) AS to_turn FROM keys WHERE level = 0 GROUP BY conv_id, s),
links AS (
  SELECT q.conv_id, q.turn, q.level, a.to_turn, sum(length(q.s)) AS chars
  FROM keys q JOIN said a ON q.conv_id = a.conv_id AND q.s = a.s WHERE q.level > 0 AND a.to_turn < q.turn
  GROUP BY q.conv_id, q.turn, q.level, a.to_turn),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, chars DESC, to_turn DESC) AS rn FROM links) WHERE rn = 1),
tree AS (
  SELECT t.conv_id, t.turn, coalesce(b.to_turn, lag(t.turn) OVER (PARTITION BY t.conv_id ORDER BY t.turn)) AS parent, b.to_turn IS NOT NULL AS by_quote
  FROM (SELECT DISTINCT conv_id, turn FROM conversations) t LEFT JOIN best b ON t.conv_id = b.conv_id AND t.turn = b.turn),
walk AS (
  SELECT conv_id, turn, 0 AS depth FROM tree WHERE parent IS NULL
  UNION ALL
  SELECT t.conv_id, t.turn, w.depth + 1 FROM tree t JOIN walk w ON t.conv_id = w.conv_id AND t.parent = w.turn),
bodies AS (
  SELECT conv_id, turn, role, count(*) FILTER (WHERE level > 0) AS n_quoted_lines,
         trim(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE level = 0), ''), ' ' || chr(10) || chr(9) || chr(13)) AS body
  FROM kept GROUP BY conv_id, turn, role)
SELECT b.conv_id, b.turn, b.role, t.parent AS parent_turn, CAST(w.depth AS BIGINT) AS depth,
       row_number() OVER (PARTITION BY b.conv_id ORDER BY w.depth, b.turn) - 1 AS position, t.by_quote,
       CAST(b.n_quoted_lines AS INTEGER) AS n_quoted_lines, b.body, '<|' || coalesce(b.role, 'unknown') || '|>' || chr(10) || b.body || chr(10) AS formatted
FROM bodies b JOIN tree t ON b.conv_id = t.conv_id AND b.turn = t.turn JOIN walk w ON b.conv_id = w.conv_id AND b.turn = w.turn"""
