"""The same results in SQL, where SQL can say them and is quick enough on whole tables."""

SQL: dict[str, str] = {}

SQL["op6_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

SQL["op7_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations
), p AS (
  SELECT conv_id, k, n,
    string_agg(coalesce(strlen(role) || ':' || role, '-') || '|' || coalesce(strlen(text) || ':' || text, '-'), '|')
      OVER (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS prefix,
    string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '')
      OVER (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS rendered
  FROM t
), whole AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS copies, any_value(n) AS n_turns, any_value(rendered) AS text
  FROM p WHERE k = n GROUP BY prefix
)
SELECT conv_id, n_turns, copies, text FROM whole
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k < p.n AND p.prefix = whole.prefix)
"""

SQL["op9_decontamination"] = r"""
WITH words AS (
  SELECT kind, id, row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (
    SELECT 'doc' AS kind, CAST(doc_id AS VARCHAR) AS id, row_number() OVER () AS row, text FROM documents
    UNION ALL SELECT 'item', coalesce(CAST(item_id AS VARCHAR), 'null'), row_number() OVER (), text FROM benchmark
  )
), windows AS (
  SELECT id, least(10, len(w)) AS size, unnest([array_to_string(w[i : i + least(10, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS win
  FROM words WHERE kind = 'item' AND len(w) > 0
), places AS (
  SELECT row, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (
    SELECT row, size, w, unnest(range(1, len(w) - size + 2)) AS i
    FROM words CROSS JOIN (SELECT DISTINCT size FROM windows) WHERE kind = 'doc' AND len(w) >= size
  )
), found AS (SELECT DISTINCT row, p.size, i, id FROM places p JOIN windows USING (size, win)),
hit AS (
  SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS k FROM found) GROUP BY row
), named AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, id FROM found) GROUP BY row
)
SELECT CAST(id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (row) LEFT JOIN named USING (row) WHERE kind = 'doc'
"""

SQL["op13_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
flags AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM w LEFT JOIN marks USING (doc_id)
),
masks AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM flags GROUP BY part, a, b, c, d, e
),
letters AS (SELECT unnest(range(1, 6)) AS f),
orders AS (
  SELECT [p.f, q.f, r.f, s.f, t.f] AS o
  FROM letters p JOIN letters q ON q.f <> p.f JOIN letters r ON r.f NOT IN (p.f, q.f)
    JOIN letters s ON s.f NOT IN (p.f, q.f, r.f) JOIN letters t ON t.f NOT IN (p.f, q.f, r.f, s.f)
),
taken AS (
  SELECT part, o, fails, n, good, toxic, coalesce(list_position(list_transform(o, lambda f: fails[f]), true), 6) AS gone
  FROM masks CROSS JOIN orders
),
steps AS (
  SELECT part, o, k AS step, o[k] AS f,
    sum(CASE WHEN gone > k THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = k THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone < k AND fails[o[k]] THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[o[k]] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = k THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = k THEN toxic ELSE 0 END) AS toxic_lost
  FROM taken CROSS JOIN (SELECT unnest(range(1, 6)) AS k) GROUP BY part, o, k
)
SELECT part, substr('ABCDE', o[1], 1) || substr('ABCDE', o[2], 1) || substr('ABCDE', o[3], 1) || substr('ABCDE', o[4], 1)
    || substr('ABCDE', o[5], 1) AS filter_order,
  CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM steps
"""

SQL["op11_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, CAST(list_inner_product(a.e, o.e) AS BIGINT) AS score
  FROM v a JOIN v o ON a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
