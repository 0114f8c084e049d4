"""DuckDB SQL with the same rows as the queries, where SQL can say it."""

from __future__ import annotations

from tasteloom.llm.sql_manifest import manifest
from tasteloom.llm.sql_trie import trie

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACED = r"'[^\x20\x09-\x0D]+'"
ALPHANUMERIC = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


LINES = f"""
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), each AS (
  SELECT doc_id, r, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM lines
), keyed AS (
  SELECT *, {_lower(f"trim(line, {BLANKS})")} AS k FROM each
), common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT keyed.*, common.k IS NOT NULL AS gone FROM keyed LEFT JOIN common USING (k)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

CONTAMINATION = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {ALPHANUMERIC}) AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, {ALPHANUMERIC}) AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
    array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM windows
), runs AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes)
), hits AS (
  SELECT doc_id, i, runs.n, item_id FROM runs JOIN windows ON runs.g = windows.g AND runs.n = windows.n
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

MIX = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {SPACED})) AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM by_source
), ordered AS (
  -- Sources reach their limit in the order of limit per weight.
  SELECT *, 3 * source_size AS most,
    coalesce(sum(3 * source_size) OVER before, 0) AS full_before,
    sum(weight) OVER onward AS weight_onward,
    sum(source_size) OVER () AS total
  FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    onward AS (ORDER BY source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT max((total - full_before)::BIGINT) FILTER (most * weight_onward >= (total - full_before) * weight) AS rest,
    max(weight_onward::BIGINT) FILTER (most * weight_onward >= (total - full_before) * weight) AS share
  FROM ordered
), aimed AS (
  SELECT source, source_size,
    CASE WHEN share IS NULL OR most * share < rest * weight THEN most::DOUBLE
      ELSE (rest * weight)::DOUBLE / share END AS target
  FROM ordered, level
), rated AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size = 0 THEN 0 ELSE least(target / source_size, 3) END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS draw
  FROM sized JOIN aimed ON sized.source IS NOT DISTINCT FROM aimed.source
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + (draw < rate - floor(rate))::INT))::BIGINT AS taken
FROM rated
"""

JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {SPACED}) AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(w[i : i + 2], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
    UNION ALL
    SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 2
  )
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * c >= 90 * (s.n + t.n - c)
), edges AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), walk AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT walk.a, edges.y FROM walk JOIN edges ON walk.b = edges.x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM walk GROUP BY a) USING (doc_id)
"""

SUBSTRINGS = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)
), firsts AS (
  SELECT g, min(doc_id) AS first FROM windows GROUP BY g
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN firsts USING (g) WHERE first < doc_id
), each AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words
), kept AS (
  SELECT each.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM each LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY each.doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

#: For the pages of the given tables, whose article element holds the whole article.
MAIN_TEXT = r"""
WITH inner_html AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS a FROM pages
), plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(a, '<(/?(p|h1)|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS t
  FROM inner_html
), decoded AS (
  SELECT page_id, url, trim(regexp_replace(
    replace(regexp_replace(replace(t, '&quot;', '"'), '&amp;?', chr(1), 'g'), chr(1), '&'), '\s+', ' ', 'g')) AS text
  FROM plain
)
SELECT page_id, url, text, length(text) AS n_chars FROM decoded
"""

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGIT = f"substr('{_ALPHABET}', (chunk >> {{}}) % 32 + 1, 1)"

ARCHIVES = f"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages
), chunks AS (
  SELECT page_id, h, s, list_transform(range(0, 8), lambda i: ('0x' || substr(s, i::INT * 5 + 1, 5))::BIGINT) AS c
  FROM hashed
), named AS (
  SELECT page_id, octet_length(encode(h)) AS payload_bytes, s,
    array_to_string(list_transform(c, lambda chunk: {" || ".join(_DIGIT.format(n) for n in (15, 10, 5, 0))}), '')
      AS payload_digest
  FROM chunks
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY s) AS first FROM named)
"""

#: Every pair of a label; near copies are few, so the components are walked from each id.
EMBEDDINGS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r
), roots AS (
  SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
), sums AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots USING (vec_id) LEFT JOIN sums USING (vec_id)
"""

SQL: dict[str, str] = {
    "op1_line_dedup": LINES,
    "op2_decontamination": CONTAMINATION,
    "op6_source_mix": MIX,
    "op7_jaccard_join": JACCARD,
    "op8_substring_dedup": SUBSTRINGS,
    "op9_main_text": MAIN_TEXT,
    "op10_warc": ARCHIVES,
    "op11_embedding_neardup": EMBEDDINGS,
    "op12_merkle_manifest": manifest(),
    "op13_prefix_trie": trie(),
}
