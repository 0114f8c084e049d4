"""Brute-force twins of the distributed operators, for small fixtures only."""

from __future__ import annotations

import math
from collections import Counter, defaultdict


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tfidf_pairs(texts: dict[int, str], threshold: float, digits: int | None = 6):
    """All ordered pairs above the threshold: ``{(mid, sim_mid): score}``."""
    counts = {mid: Counter(text.lower().replace("|", " ").split(" ")) for mid, text in texts.items()}
    df = Counter(term for tokens in counts.values() for term in tokens)
    total = len(texts)
    weights = {
        mid: {t: n * math.log((total + 1) / (df[t] + 1)) for t, n in tokens.items()}
        for mid, tokens in counts.items()
    }
    return cosine_pairs(weights, threshold, digits)


def cosine_pairs(weights: dict[int, dict], threshold: float, digits: int | None = 6):
    norm = {mid: math.sqrt(sum(w * w for w in ws.values())) for mid, ws in weights.items()}
    found = {}
    for a, left in weights.items():
        for b, right in weights.items():
            if a == b or norm[a] == 0 or norm[b] == 0:
                continue
            score = sum(w * right.get(t, 0.0) for t, w in left.items()) / (norm[a] * norm[b])
            score = score if digits is None else round(score, digits)
            if score > threshold:
                found[a, b] = score
    return found


def top_lists(pairs: dict, k: int):
    """``{mid: [(sim_mid, score), ...]}``, best first, ties by id."""
    lists = defaultdict(list)
    for (a, b), score in pairs.items():
        lists[a].append((b, score))
    return {a: sorted(found, key=lambda e: (-e[1], e[0]))[:k] for a, found in lists.items()}


def realtime(events, recents, rated, pairs, k=20, min_sim=0.7, like=3.0):
    """Candidates and final scores per user, one event per user."""
    lists = top_lists(pairs, 10**9)
    candidates, scores = {}, {}
    for uid, mid in events.items():
        unseen = [e for e in lists.get(mid, []) if (uid, e[0]) not in rated][:k]
        candidates[uid] = unseen
        final = []
        for candidate, _ in unseen:
            terms, liked, disliked = [], 0, 0
            for recent_mid, rating in recents.get(uid, []):
                similarity = pairs.get((candidate, recent_mid), 0.0)
                if similarity > min_sim:
                    terms.append(similarity * rating)
                    liked += rating > like
                    disliked += rating <= like
            if terms:
                score = sum(terms) / len(terms)
                score += math.log10(max(liked, 1)) - math.log10(max(disliked, 1))
                final.append((candidate, score))
        scores[uid] = sorted(final, key=lambda e: (-e[1], e[0]))
    return candidates, scores
