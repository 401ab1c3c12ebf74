"""DuckDB SQL of the queries that SQL can express over whole tables."""

WORD, SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM d),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS words
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM f WHERE len(w) >= 8)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, words) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(n) AS n FROM (
    SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS n FROM twice) GROUP BY r),
q AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{SPACE}', '', 'g')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         coalesce(c.n, 0) AS n_repeat_words
  FROM f LEFT JOIN covered c USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words
            OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 2 * n_upper > word_chars) AS kept
FROM q"""

JACCARD = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM d),
n AS (SELECT id, count(*) AS c FROM s GROUP BY id),
p AS (SELECT a.id AS x, b.id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY a.id, b.id),
l AS (SELECT x, y FROM p JOIN n nx ON nx.id = x JOIN n ny ON ny.id = y WHERE 100 * i >= 80 * (nx.c + ny.c - i)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT id AS node, id AS reach FROM d UNION SELECT r.node, e.y FROM r JOIN e ON r.reach = e.x),
m AS (SELECT node, min(doc_id) AS component_id FROM r JOIN d ON r.reach = d.id GROUP BY node)
SELECT d.doc_id, CAST(coalesce(c, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n USING (id) JOIN m ON m.node = d.id"""


#: CRC-32 (the reflected polynomial 0xEDB88320) byte by byte through a table, as lambdas.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, j:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

#: Words of at least five letters and three occurrences, their near words by shared
#: deletions at one place, forms and roots.
SPELLING = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
                translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
         FROM documents),
counted AS (SELECT doc, run, count(*) AS times FROM runs GROUP BY doc, run),
bytes AS (SELECT run, times, flatten(list_transform(string_split(doc || ':' || run, ''), lambda ch:
                 CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] ELSE [195, unicode(ch) - 64] END)) AS b
          FROM counted WHERE length(run) >= 5),
hashed AS (SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(b, lambda x: CAST(x AS BIGINT))),
                 lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
           FROM bytes, crc),
words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, (h % length(run)) + 2)
                           ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cuts AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, w.word FROM cuts a JOIN words w ON a.rest = w.word
  UNION SELECT w.word, a.word FROM cuts a JOIN words w ON a.rest = w.word),
best AS (
  SELECT near.word, near.other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, near.other) AS place
  FROM near JOIN words o ON near.other = o.word),
judged AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word AND b.place = 1),
up AS (
  SELECT word, form AS at FROM judged WHERE form IS NOT NULL
  UNION ALL
  SELECT up.word, j.form FROM up JOIN judged j ON up.at = j.word WHERE j.form IS NOT NULL)
SELECT j.word, j.form, coalesce(u.at, j.word) AS root, j.n, j.n_near, j.form_n
FROM judged j
LEFT JOIN (SELECT up.word, up.at FROM up JOIN judged e ON up.at = e.word WHERE e.form IS NULL) u ON j.word = u.word
"""

#: Hard negatives over all pairs of an anchor and a row.
MINING = """
WITH good AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM good a JOIN good r ON a.vec_id <> r.vec_id AND len(a.q) = len(r.q)
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (
           PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
         n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 100 * n.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
SELECT * FROM ranked WHERE rank <= 10
"""
