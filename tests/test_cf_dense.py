"""Item-cosine recommendation against a dense numpy model of the same rules."""

import numpy as np
import pytest

from listenlens.operators import recommend, similarity


def dense_top_k(m, users, items, k):
    norms = np.sqrt((m * m).sum(axis=0))
    safe = np.where(norms > 0, norms, 1.0)
    sim = (m.T @ m) / np.outer(safe, safe)
    sim[:, norms == 0] = 0.0
    sim[norms == 0, :] = 0.0
    out = {}
    for u, row in zip(users, m):
        if not (row > 0).any():
            continue
        scores = np.round(sim @ row, 6)
        cand = [(-scores[j], items[j]) for j in range(len(items)) if row[j] == 0]
        out[u] = [s for _, s in sorted(cand)[:k]]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_recommend_all_matches_dense(spark, seed):
    rng = np.random.default_rng(seed)
    n_users, n_items = 15, 12
    m = np.where(rng.random((n_users, n_items)) < 0.35, rng.integers(1, 9, (n_users, n_items)), 0).astype(float)
    m[:, 3] = 0.0  # an item nobody heard: zero norm, still a candidate with score 0
    users = [f"u{i:02d}" for i in range(n_users)]
    items = [f"s{j:02d}" for j in range(n_items)]
    rows = [(users[i], items[j], float(m[i, j])) for i in range(n_users) for j in range(n_items) if m[i, j] > 0]
    train = spark.createDataFrame(rows, "user_id string, song_id string, play_count double")
    universe = spark.createDataFrame([(s,) for s in items], "song_id string")
    sim = similarity.item_cosine(train, block_size=5)
    recs = recommend.recommend_all(train, sim, items=universe, k=4)
    got = {}
    for r in recs.collect():
        got.setdefault(r.user_id, []).append((r.rank, r.song_id))
    got = {u: [s for _, s in sorted(v)] for u, v in got.items()}
    assert got == dense_top_k(m, users, items, 4)
