"""SQL of the conversation trie: prefixes as lists, compared whole."""

from __future__ import annotations

# CRC-32 of the decimal id: the table of its 256 steps, then one step for each letter.
_TABLE = """
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps"""
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(range(1, len(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)),
    lambda a, x: xor(steps[(xor(a, x) & 255) + 1], a >> 8)), 4294967295)"""

SQL = f"""
WITH crc AS ({_TABLE}),
turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t,
    left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS x
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, x) AS s FROM turns GROUP BY c),
convs AS (SELECT own.c, s, {_CRC} % 9 AS h FROM own, crc),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.s, [])[1:a.h], a.s[a.h + 1:]) AS s
  FROM convs a LEFT JOIN own b ON b.c = a.c - a.c % 5),
paths AS (
  SELECT c, len(s) AS n, d, s[1:d] AS p, CASE WHEN d > 0 THEN s[1:d - 1] END AS above
  FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, p, any_value(above) AS above, min(c) AS conv_id, count(*) AS n_convs, max(n) = d AS leaf,
    (count(*) - 1) * coalesce(strlen(p[d].t), 0) AS saved,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends
  FROM paths GROUP BY d, p),
kids AS (SELECT d - 1 AS d, above AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT a.d, a.p, sum(b.leaf::INT) AS n_leaves, sum(b.saved) AS saved
  FROM nodes b JOIN paths x ON x.c = b.conv_id AND x.d <= b.d JOIN nodes a ON a.d = x.d AND a.p = x.p GROUP BY a.d, a.p)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.p = n.p
LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.above
LEFT JOIN kids k ON k.d = n.d AND k.p = n.p
"""
