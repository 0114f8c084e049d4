"""SQL of the Merkle manifest; its levels are written out, as many as 3**12 leaves need."""

from __future__ import annotations

LEVELS = 12

#: CRC-32 of the decimal doc_id, bit by bit; the number is the polynomial (fixed value).
CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(range(1, length(d) + 1), lambda i: ascii(d[i])::UBIGINT)),
    lambda c, b: list_reduce(
        list_concat([xor(c, b)], list_transform(range(8), lambda i: 0::UBIGINT)),
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)))"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_TAMPERED = "CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


def _levels(name: str, groups: str) -> list[str]:
    """CTEs ``name0`` (given) to ``nameN``: ``{groups}, j, h``; a lone node stays as it is."""
    key = f"{groups}, " if groups else ""
    over = f"PARTITION BY {groups}" if groups else ""
    return [
        f"""{name}r{i} AS (
  SELECT {key}j // 3 AS j, list(h ORDER BY j) AS run, any_value(n) AS n
  FROM (SELECT *, count(*) OVER ({over}) AS n FROM {name}{i}) GROUP BY {key}j // 3
), {name}{i + 1} AS (
  SELECT {key}j, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h FROM {name}r{i}
)"""
        for i in range(LEVELS)
    ]


def _walk(start: str, name: str, join: str, after: str) -> list[str]:
    """CTEs that take ``doc, s, k, f, proof`` from ``start`` up through the levels of ``name``."""
    steps = []
    for i in range(LEVELS):
        before = start if i == 0 else f"{after}{i}"
        steps.append(
            f"""{after}{i + 1} AS (
  SELECT w.* REPLACE (
    w.k // 3 AS k,
    CASE WHEN n = 1 THEN f ELSE sha256(array_to_string(
      list_transform(run, lambda x, i: CASE WHEN i = w.k % 3 + 1 THEN f ELSE x END), '')) END AS f,
    CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(
      list_filter(run, lambda x, i: i <> w.k % 3 + 1), '') END AS proof)
  FROM {before} w JOIN {name}r{i} r ON {join} r.j = w.k // 3
)"""
        )
    return steps


def manifest() -> str:
    parts = [
        f"""ids AS (
  SELECT *, coalesce(doc_id::VARCHAR, '') AS d FROM documents
), crcs AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN 1 ELSE {CRC} END AS crc FROM ids
), leaves AS (
  SELECT doc_id, source, sha256({_HEAD} || {_FIELD.format('text')}) AS h,
    sha256({_HEAD} || {_FIELD.format(f'({_TAMPERED})')}) AS shown FROM crcs
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS j FROM leaves
), a0 AS (
  SELECT s, j, h FROM placed
)""",
        *_levels("a", "s"),
        f"b0 AS (SELECT s AS j, h FROM a{LEVELS})",
        *_levels("b", ""),
        "w0 AS (SELECT doc_id, s, j, h, j AS k, shown AS f, '' AS proof FROM placed)",
        *_walk("w0", "a", "r.s = w.s AND", "w"),
        f"v0 AS (SELECT * REPLACE (s AS k) FROM w{LEVELS})",
        *_walk("v0", "b", "", "v"),
    ]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, v.h AS leaf, a.h AS subroot, b.h AS root, sha256(proof) AS proof_sha256,
  f AS folded_root, f = b.h AS verified
FROM v{LEVELS} v JOIN a{LEVELS} a ON a.s = v.s CROSS JOIN b{LEVELS} b"""
