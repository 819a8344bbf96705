"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

RULES_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT doc_id, text,
    [x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM t
), starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM split
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(ws, i, i + 7)) AS n FROM starts
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM windows, unnest(range(0, 8)) AS u(k) WHERE n > 1 GROUP BY doc_id
), measured AS (
  SELECT doc_id,
    CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS capitals,
    len(ls) AS n_lines
  FROM split LEFT JOIN covered USING (doc_id)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
    OR 10 * capitals > 4 * word_chars
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM based
"""

NEAR_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, [x FOR x IN string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM split WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)
), sides AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT a AS doc_id, a AS seen FROM sides
  UNION
  SELECT reached.doc_id, sides.b FROM reached JOIN sides ON sides.a = reached.seen
), least AS (
  SELECT doc_id, min(seen) AS component FROM reached GROUP BY doc_id
)
SELECT split.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles,
  coalesce(least.component, split.doc_id) AS component_id,
  split.doc_id = coalesce(least.component, split.doc_id) AS kept
FROM split LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

COLLOCATIONS_SQL = r"""
WITH split AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]') AS ps
  FROM documents
), pieces AS (
  SELECT lang, unnest(ps) AS p FROM split
), words AS (
  SELECT lang, [w FOR w IN string_split_regex(p, '[\x20\x09]+') IF w <> ''] AS ws FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words
), grams AS (
  SELECT lang, list_slice(ws, i, i + size - 1) AS g
  FROM starts, unnest([1, 2, 3, 4]) AS s(size) WHERE i + size - 1 <= len(ws)
), f AS (
  SELECT lang, g, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 30
), cuts AS (
  SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1
), scored AS (
  SELECT c.lang, c.g, c.a, c.k, l.f AS l, r.f AS r, 2000000 * c.a // (l.f + r.f) AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.g = list_slice(c.g, 1, c.k)
  JOIN f r ON r.lang = c.lang AND r.g = list_slice(c.g, c.k + 1, len(c.g))
), least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, list_slice(g, i, i + size - 1) AS g, max(f) AS around
  FROM f, unnest([2, 3]) AS s(size), unnest([1, 2, 3]) AS t(i)
  WHERE size < len(g) AND i + size - 1 <= len(g) GROUP BY ALL
), free AS (
  SELECT least.*, array_to_string(g, ' ') AS phrase FROM least LEFT JOIN inner_ USING (lang, g)
  WHERE around IS NULL OR 100 * around < 80 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

NEGATIVES_SQL = r"""
WITH finite AS (
  SELECT row_number() OVER () AS row_, vec_id, label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(embedding) = len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)])
), base AS (
  SELECT row_, vec_id, v,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM finite
), scores AS (
  SELECT a.row_ AS row_, a.vec_id AS anchor_id, b.row_ AS other, b.vec_id AS vec_id, a.label = b.label AS same,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM base a, base b WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT row_, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM scores
  WHERE same AND other <> row_
  QUALIFY row_number() OVER (PARTITION BY row_ ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.row_, p.other ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scores s ON s.row_ = p.row_
  WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": RULES_SQL,
    "op7_near_dedup": NEAR_SQL,
    "op12_collocations": COLLOCATIONS_SQL,
    "op13_hard_negatives": NEGATIVES_SQL,
}
