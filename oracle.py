"""SQL equivalents of the queries, over the same tables."""

from __future__ import annotations

PREFIX = "MOVIE_RATING_PREFIX:"

CATALOGUE_GENRES = (
    "ECONOMY LARGE MEDIUM PROMO SMALL STANDARD anvil blue bolt cold gear gizmo hot new old "
    "plate red ring rod widget"
).split()



def murmur3(text: str, seed: int = 42) -> int:
    """Signed 32-bit MurmurHash3, the public x86 variant."""
    mask = 0xFFFFFFFF
    data = text.encode()

    def rotate(x: int, by: int) -> int:
        return ((x << by) | (x >> (32 - by))) & mask

    def scramble(word: int) -> int:
        return rotate(word * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask

    value = seed
    whole = len(data) // 4 * 4
    for at in range(0, whole, 4):
        value ^= scramble(int.from_bytes(data[at : at + 4], "little"))
        value = (rotate(value, 13) * 5 + 0xE6546B64) & mask
    value ^= scramble(int.from_bytes(data[whole:], "little"))
    value ^= len(data)
    value = (value ^ value >> 16) * 0x85EBCA6B & mask
    value = (value ^ value >> 13) * 0xC2B2AE35 & mask
    value ^= value >> 16
    return value - (1 << 32) if value >> 31 else value


# Hash bucket of every word of the catalogue, out of 50.
BUCKETS = {word.lower(): murmur3(word.lower()) % 50 for word in CATALOGUE_GENRES}

CTES = {
    "buckets": "SELECT * FROM (VALUES "
    + ", ".join(f"('{word}', {bucket})" for word, bucket in BUCKETS.items())
    + ") AS b(term, bucket)",
    "htf": """
        SELECT mid, bucket, sum(tf) AS tf FROM tf JOIN buckets USING (term)
        GROUP BY mid, bucket""",
    "hwt": """
        SELECT mid, bucket, tf * ln(((SELECT count(*) FROM items) + 1.0)
                   / (count(*) OVER (PARTITION BY bucket) + 1.0)) AS weight FROM htf""",
    "hunit": """
        SELECT mid, bucket, weight / sqrt(sum(weight * weight) OVER (PARTITION BY mid)) AS u
        FROM hwt QUALIFY sum(weight * weight) OVER (PARTITION BY mid) > 0""",
    "hpairs": """
        SELECT a.mid AS mid, b.mid AS sim_mid, round(sum(a.u * b.u), 6) AS score
        FROM hunit a JOIN hunit b ON a.bucket = b.bucket AND a.mid <> b.mid
        GROUP BY a.mid, b.mid HAVING round(sum(a.u * b.u), 6) > 0.6""",
    "ratings": """
        SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(l_partkey AS INTEGER) AS mid,
               ceil(l_quantity / 5) / 2 AS score,
               CAST(floor(epoch(o_orderdate)) AS BIGINT) AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
               p_type || '|' || replace(p_name, ' ', '|') AS genres
        FROM part""",
    "genres": "SELECT unnest([" + ", ".join(f"'{g}'" for g in CATALOGUE_GENRES) + "]) AS genre",
    "tags": """
        SELECT CAST(user_id AS INTEGER) AS uid,
               CAST(event_id % (SELECT count(*) FROM part) AS INTEGER) AS mid,
               event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp
        FROM events""",
    "ev": """
        SELECT CAST(user_id AS INTEGER) AS uid,
               CAST(event_id % (SELECT count(*) FROM part) AS INTEGER) AS mid,
               ceil(least(value, 100) / 10) / 2 AS score,
               CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, event_type
        FROM events""",
    "messages": """
        SELECT uid || '|' || mid || '|' || score || '|' || timestamp AS value, event_type
        FROM ev""",
    "last_event": """
        SELECT uid, mid, score, timestamp FROM ev QUALIFY row_number() OVER (
            PARTITION BY uid ORDER BY timestamp DESC, mid, score DESC) = 1""",
    "recents": """
        SELECT uid, CAST(row_number() OVER w - 1 AS INTEGER) AS pos, mid, score, timestamp
        FROM ratings
        WINDOW w AS (PARTITION BY uid ORDER BY timestamp DESC, mid, score DESC)
        QUALIFY row_number() OVER w <= 20""",
    "tok": """
        SELECT mid, unnest(string_split(lower(replace(genres, '|', ' ')), ' ')) AS term
        FROM items""",
    "tf": "SELECT mid, term, count(*) AS tf FROM tok GROUP BY mid, term",
    "idf": """
        SELECT term, count(*) AS df,
               ln(((SELECT count(*) FROM items) + 1.0) / (count(*) + 1.0)) AS idf
        FROM tf GROUP BY term""",
    "wt": "SELECT mid, term, tf, idf, tf * idf AS weight FROM tf JOIN idf USING (term)",
    "unit": """
        SELECT mid, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY mid)) AS u
        FROM wt QUALIFY sum(weight * weight) OVER (PARTITION BY mid) > 0""",
    "pairs": """
        SELECT a.mid AS mid, b.mid AS sim_mid, round(sum(a.u * b.u), 6) AS score
        FROM unit a JOIN unit b ON a.term = b.term AND a.mid <> b.mid
        GROUP BY a.mid, b.mid HAVING round(sum(a.u * b.u), 6) > 0.6""",
    "signature": """
        SELECT mid, string_agg(term || ':' || tf, ',' ORDER BY term) AS sig
        FROM tf GROUP BY mid""",
    "classes": "SELECT mid, min(mid) OVER (PARTITION BY sig) AS cls FROM signature",
    "vecs": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "vclasses": "SELECT vec_id, min(vec_id) OVER (PARTITION BY v) AS cls FROM vecs",
    "vpairs": """
        SELECT a.vec_id AS vec_id, b.vec_id AS sim_vec_id,
               round(list_cosine_similarity(a.v, b.v), 6) AS score
        FROM vecs a JOIN vecs b ON a.vec_id <> b.vec_id
        WHERE round(list_cosine_similarity(a.v, b.v), 6) > 0.3""",
    "cand": """
        SELECT e.uid, p.sim_mid AS mid, p.score,
               CAST(row_number() OVER w AS INTEGER) AS rank
        FROM last_event e JOIN pairs p ON p.mid = e.mid
        WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = e.uid AND r.mid = p.sim_mid)
        WINDOW w AS (PARTITION BY e.uid ORDER BY p.score DESC, p.sim_mid)
        QUALIFY row_number() OVER w <= 20""",
    "scored": """
        SELECT c.uid, c.mid, CAST(round(CAST(
                   avg(p.score * r.score)
                   + log10(greatest(count(*) FILTER (r.score > 3), 1))
                   - log10(greatest(count(*) FILTER (r.score <= 3), 1))
               AS DECIMAL(18, 9)), 6) AS DOUBLE) AS score
        FROM cand c JOIN recents r ON r.uid = c.uid
        JOIN pairs p ON p.mid = c.mid AND p.sim_mid = r.mid
        WHERE p.score > 0.7
        GROUP BY c.uid, c.mid""",
}

NEEDS = {
    "htf": ["tf", "buckets"],
    "hwt": ["htf", "items"],
    "hunit": ["hwt"],
    "hpairs": ["hunit"],
    "messages": ["ev"],
    "last_event": ["ev"],
    "recents": ["ratings"],
    "tok": ["items"],
    "tf": ["tok"],
    "idf": ["tf", "items"],
    "wt": ["tf", "idf"],
    "unit": ["wt"],
    "pairs": ["unit"],
    "signature": ["tf"],
    "classes": ["signature"],
    "vclasses": ["vecs"],
    "vpairs": ["vecs"],
    "cand": ["last_event", "pairs", "ratings"],
    "scored": ["cand", "recents", "pairs"],
}


def _with(names: str, body: str) -> str:
    """``body`` with the named CTEs and all they need in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    heads = [
        f"{n} AS {'MATERIALIZED ' if n in ('pairs', 'unit', 'hpairs', 'hunit', 'cand') else ''}({CTES[n]})"
        for n in order
    ]
    return f"WITH {', '.join(heads)} {body}"


RATE_MORE = _with("ratings", "SELECT mid, count(mid) AS count FROM ratings GROUP BY mid")
MONTH = "CAST(strftime(make_timestamp(timestamp * 1000000), '%Y%m') AS INTEGER)"
RATE_MORE_RECENTLY = _with(
    "ratings",
    f"""SELECT mid, count(mid) AS count, {MONTH} AS yearmonth FROM ratings
        GROUP BY mid, {MONTH}""",
)
AVERAGE = _with(
    "ratings", "SELECT mid, round(avg(score), 6) AS avg FROM ratings GROUP BY mid"
)
LOG_RATINGS = _with(
    "messages",
    """SELECT 'logProcessor' AS key, value FROM messages
       WHERE event_type IN ('view', 'purchase')""",
)
REALTIME = _with(
    "scored",
    """SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER)
              AS rank, mid, score FROM scored""",
)
VECTOR_TOP = _with(
    "vpairs",
    """SELECT vec_id, CAST(row_number() OVER w AS INTEGER) AS rank, sim_vec_id, score FROM vpairs
       WINDOW w AS (PARTITION BY vec_id ORDER BY score DESC, sim_vec_id)
       QUALIFY row_number() OVER w <= 10""",
)

SQL = {
    "genres_top": _with(
        "ratings items genres",
        """SELECT genre, CAST(row_number() OVER w AS INTEGER) AS rank, mid, round(avg, 6) AS avg
           FROM (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid) a
           JOIN items USING (mid)
           JOIN genres ON contains(lower(items.genres), lower(genre))
           WINDOW w AS (PARTITION BY genre ORDER BY avg DESC, mid)
           QUALIFY row_number() OVER w <= 10""",
    ),
    "rate_more_items": RATE_MORE,
    "sql_rate_more_items": RATE_MORE,
    "rate_more_recently": RATE_MORE_RECENTLY,
    "sql_rate_more_recently": RATE_MORE_RECENTLY,
    "average_items": AVERAGE,
    "sql_average_items": AVERAGE,
    "monthly_scores": _with("ratings", f"SELECT mid, score, {MONTH} AS yearmonth FROM ratings"),
    "genre_matches": _with(
        "items genres",
        """SELECT mid, genre FROM items
           JOIN genres ON contains(lower(items.genres), lower(genre))""",
    ),
    "item_tags": _with(
        "tags",
        "SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM tags GROUP BY mid",
    ),
    "items_with_tags": _with(
        "items tags",
        """SELECT mid, name, genres, t.tags FROM items LEFT JOIN (
               SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags
               FROM tags GROUP BY mid) t USING (mid)""",
    ),
    "parsed_items": """
        SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name, p_brand AS descri,
               CAST(p_size AS VARCHAR) AS timelong, '' AS issue, '' AS shoot, '' AS language,
               upper(p_type) AS genres, p_brand AS actors, '' AS directors
        FROM part""",
    "parsed_ratings": _with("ratings", "SELECT uid, mid, score, timestamp FROM ratings"),
    "stored_ratings": _with("ratings", "SELECT uid, mid, score, timestamp FROM ratings"),
    "parsed_tags": _with("tags", "SELECT uid, mid, tag, timestamp FROM tags"),
    "rejected_lines": _with(
        "messages",
        f"""SELECT '{PREFIX}' || value AS value FROM messages
            WHERE event_type IN ('view', 'purchase')""",
    ),
    "keyed_tags": _with(
        "tags",
        """SELECT uid, mid, tag, timestamp FROM tags QUALIFY row_number() OVER (
               PARTITION BY mid ORDER BY timestamp DESC, uid, tag) = 1""",
    ),
    "content_term_weights": _with(
        "wt",
        """SELECT mid, term, CAST(tf AS DOUBLE) AS tf, round(idf, 6) AS idf,
                  round(weight, 6) AS weight FROM wt""",
    ),
    "content_idf": _with("idf", "SELECT term, df, round(idf, 6) AS idf FROM idf"),
    "content_classes": _with("classes", "SELECT mid, cls FROM classes"),
    "content_similar": _with(
        "pairs classes",
        """SELECT p.mid, c.cls AS sim_cls, max(p.score) AS score, count(*) AS n_similar,
                  CAST(row_number() OVER (
                      PARTITION BY p.mid ORDER BY max(p.score) DESC, c.cls) AS INTEGER) AS rank
           FROM pairs p JOIN classes c ON c.mid = p.sim_mid GROUP BY p.mid, c.cls""",
    ),
    "content_similar_counts": _with(
        "pairs", "SELECT mid, count(*) AS n_similar FROM pairs GROUP BY mid"
    ),
    "content_similar_top20": _with(
        "pairs",
        """SELECT mid, CAST(row_number() OVER w AS INTEGER) AS rank, sim_mid, score FROM pairs
           WINDOW w AS (PARTITION BY mid ORDER BY score DESC, sim_mid)
           QUALIFY row_number() OVER w <= 20""",
    ),
    "content_hashed_weights": _with(
        "hwt", "SELECT mid, bucket, round(weight, 6) AS weight FROM hwt WHERE weight <> 0"
    ),
    "content_hashed_top20": _with(
        "hpairs",
        """SELECT mid, CAST(row_number() OVER w AS INTEGER) AS rank, sim_mid, score FROM hpairs
           WINDOW w AS (PARTITION BY mid ORDER BY score DESC, sim_mid)
           QUALIFY row_number() OVER w <= 20""",
    ),
    "vector_similar": _with(
        "vpairs vclasses",
        """SELECT p.vec_id, c.cls AS sim_cls, max(p.score) AS score, count(*) AS n_similar,
                  CAST(row_number() OVER (
                      PARTITION BY p.vec_id ORDER BY max(p.score) DESC, c.cls) AS INTEGER) AS rank
           FROM vpairs p JOIN vclasses c ON c.vec_id = p.sim_vec_id
           GROUP BY p.vec_id, c.cls""",
    ),
    "vector_similar_top10": VECTOR_TOP,
    "similar_map_lookup": f"""
        WITH best AS ({VECTOR_TOP})
        SELECT vec_id, coalesce(max(score) FILTER (sim_vec_id = vec_id + 1), 0) AS score
        FROM best GROUP BY vec_id""",
    "vector_cosine": """
        SELECT e.vec_id, round(list_cosine_similarity(
                   CAST(e.embedding AS DOUBLE[]), CAST(f.embedding AS DOUBLE[])), 6) AS score
        FROM embeddings e
        JOIN (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label) m
            ON m.label = e.label
        JOIN embeddings f ON f.vec_id = m.vec_id""",
    "distinct_users": _with("ratings", "SELECT DISTINCT uid FROM ratings"),
    "distinct_items": _with("ratings", "SELECT DISTINCT mid FROM ratings"),
    "candidate_grid_count": _with(
        "ratings",
        """SELECT count(DISTINCT uid) AS users, count(DISTINCT mid) AS items,
                  count(DISTINCT uid) * count(DISTINCT mid) AS pairs FROM ratings""",
    ),
    "topk_per_user": _with(
        "ratings",
        """SELECT uid, CAST(row_number() OVER w AS INTEGER) AS rank, mid, score
           FROM (SELECT DISTINCT uid, mid FROM ratings)
           JOIN (SELECT mid, round(avg(score), 6) AS score FROM ratings GROUP BY mid) USING (mid)
           WINDOW w AS (PARTITION BY uid ORDER BY score DESC, mid)
           QUALIFY row_number() OVER w <= 20""",
    ),
    "rmse_item_mean": _with(
        "ratings",
        """SELECT round(sqrt(avg((t.score - m.avg) * (t.score - m.avg))), 6) AS rmse
           FROM ratings t JOIN (
               SELECT mid, avg(score) AS avg FROM ratings
               WHERE (uid * 31 + mid) % 5 <> 0 GROUP BY mid) m USING (mid)
           WHERE (t.uid * 31 + t.mid) % 5 = 0""",
    ),
    "rating_messages": _with("ev", "SELECT uid, mid, score, timestamp FROM ev"),
    "log_ratings": LOG_RATINGS,
    "stream_log_ratings": LOG_RATINGS,
    "last_events": _with("last_event", "SELECT uid, mid, score, timestamp FROM last_event"),
    "recent_ratings": _with("recents", "SELECT uid, pos, mid, score, timestamp FROM recents"),
    "recent_entries": _with("recents", "SELECT uid, pos, mid, score FROM recents"),
    "event_candidates": _with("cand", "SELECT uid, rank, mid, score FROM cand"),
    "pair_similarity": _with(
        "last_event recents pairs",
        """SELECT e.uid, e.mid, r.mid AS recent_mid, coalesce(p.score, 0) AS score
           FROM last_event e JOIN recents r ON r.uid = e.uid
           LEFT JOIN pairs p ON p.mid = e.mid AND p.sim_mid = r.mid""",
    ),
    "realtime_scores": REALTIME,
    "stream_realtime": REALTIME,
    "stream_recent_state": _with(
        "ratings ev",
        """SELECT uid, CAST(row_number() OVER w - 1 AS INTEGER) AS pos, mid, score, timestamp
           FROM (SELECT uid, mid, score, timestamp FROM ratings
                 UNION ALL SELECT uid, mid, score, timestamp FROM ev)
           WINDOW w AS (PARTITION BY uid ORDER BY timestamp DESC, mid, score DESC)
           QUALIFY row_number() OVER w <= 20""",
    ),
    "realtime_list_sizes": _with(
        "last_event scored",
        """SELECT e.uid, CAST(count(s.mid) AS INTEGER) AS n
           FROM last_event e LEFT JOIN scored s ON s.uid = e.uid GROUP BY e.uid""",
    ),
    "latest_user_events": _with(
        "ev",
        """SELECT uid, mid, score, timestamp, timestamp // 86400 AS batch_id FROM ev
           QUALIFY row_number() OVER (
               PARTITION BY uid ORDER BY timestamp DESC, mid, score DESC) = 1""",
    ),
    "replaced_under_reader": _with(
        "ratings",
        """SELECT 'early' AS reader, count(*) AS n, sum(score) AS score_sum FROM ratings
           UNION ALL SELECT 'late', count(*), sum(score) FROM ratings WHERE score < 3""",
    ),
}
SQL["stream_recent_in_state"] = SQL["stream_recent_state"]
SQL["stream_realtime_in_state"] = SQL["stream_realtime"]
SQL["merged_user_events"] = SQL["latest_user_events"]
SQL["keyed_document_table"] = SQL["items_with_tags"]
SQL["stream_log_topology"] = SQL["stream_log_ratings"]
SQL["colocated_item_scores"] = _with(
    "items ratings",
    """SELECT i.mid, i.name, count(r.score) AS n, sum(r.score) AS score_sum
       FROM items i LEFT JOIN ratings r ON r.mid = i.mid GROUP BY i.mid, i.name""",
)
