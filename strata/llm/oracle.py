"""DuckDB statements for the queries of this subpackage that SQL can express."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, substr(md5(CAST(doc_id AS VARCHAR)), 1, 3) AS tie,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT a.source, a.source_size, a.weight, 3 * a.source_size / CAST(a.weight AS DOUBLE) AS ratio,
         (SELECT sum(source_size) FROM per_source) AS total,
         coalesce((SELECT sum(3 * b.source_size) FROM per_source b
                   WHERE (3 * b.source_size / CAST(b.weight AS DOUBLE), b.source IS NULL, coalesce(b.source, ''))
                       < (3 * a.source_size / CAST(a.weight AS DOUBLE), a.source IS NULL, coalesce(a.source, ''))), 0) AS gone,
         (SELECT sum(b.weight) FROM per_source b
          WHERE (3 * b.source_size / CAST(b.weight AS DOUBLE), b.source IS NULL, coalesce(b.source, ''))
             >= (3 * a.source_size / CAST(a.weight AS DOUBLE), a.source IS NULL, coalesce(a.source, ''))) AS open_weight
  FROM per_source a
), level AS (
  SELECT max(CAST(total - gone AS DOUBLE) / CAST(open_weight AS DOUBLE)) AS level FROM levels
  WHERE CAST(total - gone AS DOUBLE) / CAST(open_weight AS DOUBLE) <= ratio
), targets AS (
  SELECT source, source_size,
         least(CAST(weight AS DOUBLE) * level, CAST(3 * source_size AS DOUBLE)) AS target
  FROM levels, level
), steps AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 268435456.0::DOUBLE) AS BIGINT) ELSE 0 END AS step,
         CAST('0x' || substr(md5('7|' || coalesce(source, '')), 1, 7) AS BIGINT) AS start
  FROM targets
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.step, t.start,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.tie, s.doc_id) - 1 AS place
  FROM sized s JOIN steps t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       size * (((start + (place + 1) * step) >> 28) - ((start + place * step) >> 28)) AS taken
FROM placed
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), blocks AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM turns
), sized AS (
  SELECT *, length(regexp_replace(text, '<(\\*)(turn|/turn|part)', '<\\\1\2', 'g'))
       + CASE WHEN before = role THEN 6
              ELSE 7 + 8 + length(role) + length(regexp_replace(role, '[^<>\\]', '', 'g')) END AS chars
  FROM blocks
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM worded
), items AS (
  SELECT doc_id, unnest(s) AS item FROM sets
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
  WHERE 100 * both_have >= 85 * (len(p.s) + len(q.s) - both_have)
), reach AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), smallest AS (
  SELECT x, min(y) AS low FROM reach GROUP BY x
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.low, d.doc_id)) AS kept
FROM sets d LEFT JOIN smallest m ON m.x = d.doc_id
"""

PREFIX_TRIE = r"""
WITH ids AS (
  SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), hashed AS (
  SELECT conv_id, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda state, byte: list_reduce([xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)),
         CAST(4294967295 AS BIGINT)) % 9 AS h
  FROM ids
), placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), parts AS (
  SELECT h.conv_id, 0 AS part, p.place, p.role, p.text
  FROM hashed h JOIN placed p ON p.conv_id = h.conv_id - h.conv_id % 5 AND p.place <= h.h
  UNION ALL
  SELECT h.conv_id, 1, p.place, p.role, p.text FROM hashed h JOIN placed p ON p.conv_id = h.conv_id AND p.place > h.h
), rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, role, text FROM parts
), lengths AS (
  SELECT i.conv_id, coalesce(max(r.depth), 0) AS length FROM ids i LEFT JOIN rebuilt r USING (conv_id) GROUP BY 1
), prefixes AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS bytes,
         string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS name,
         coalesce(string_agg(sha256(role) || sha256(text), '') OVER (
           PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS up
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM ids
), nodes AS (
  SELECT name, depth, min(conv_id) AS conv_id, any_value(up) AS up, count(*) AS n_convs, any_value(bytes) AS bytes,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = length) AS ends
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY name, depth
), children AS (
  SELECT up AS name, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT p.name, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((m.n_convs - 1) * m.bytes) AS saved_tokens
  FROM nodes m JOIN prefixes p ON p.conv_id = m.conv_id AND p.depth <= m.depth LEFT JOIN children c ON c.name = m.name
  GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.name = n.name LEFT JOIN nodes u ON u.name = n.up AND n.depth > 0
LEFT JOIN children c ON c.name = n.name
"""

FILTER_AUDIT = r"""
WITH worded AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         coalesce(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first FROM worded GROUP BY text
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), facts AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map {
    'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
    'C': 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 10 * length(d.text),
    'D': regexp_matches(d.text, '[#$%&*|]'), 'E': coalesce(d.doc_id > first, false)} AS fails
  FROM worded d JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)
), counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM facts GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, string_split(filter_order[1:step - 1], '') AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), judged AS (
  SELECT c.*, s.filter_order, s.step, s.letter, c.fails[s.letter] AS failed,
         s.step > 1 AND list_bool_or(list_transform(s.before, lambda x: coalesce(c.fails[x], false))) AS gone,
         len(list_filter(map_values(c.fails), lambda x: x)) AS n_failed
  FROM counted c, steps s
), audited AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT failed AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failed AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed AND n_failed = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN failed AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN failed AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM audited
"""
