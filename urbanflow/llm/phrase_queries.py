"""SQL of the collocations: all phrases counted as lists of words."""

from __future__ import annotations

SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS ks(k))
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT c.lang, c.p, c.k, c.f AS a, l.f AS l, r.f AS r, n, j,
    (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j, string_split(p, ' ') AS s FROM counts WHERE k > 1) c
  JOIN counts l ON l.lang = c.lang AND l.p = array_to_string(c.s[:j], ' ')
  JOIN counts r ON r.lang = c.lang AND r.p = array_to_string(c.s[j + 1:], ' ')
  JOIN total t ON t.lang = c.lang),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank FROM scored s
  WHERE NOT EXISTS (
    SELECT 1 FROM counts q
    WHERE q.lang = s.lang AND q.k > s.k AND 100 * q.f >= 100 * s.a AND contains(' ' || q.p || ' ', ' ' || s.p || ' ')))
SELECT lang, rank, p AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
