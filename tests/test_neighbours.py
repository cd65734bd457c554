"""The similarity join against brute force."""

import random

import numpy as np
import pytest

from listenlens.operators import neighbours
from listenlens.operators.neighbours import item_neighbours


def brute(rows, k):
    total = {}
    for u, i, v in rows:
        if u is not None and i is not None and v is not None and v > 0:
            total[u, i] = total.get((u, i), 0) + v
    users, items = sorted({u for u, _ in total}), sorted({i for _, i in total})
    x = np.zeros((len(items), len(users)))
    for (u, i), v in total.items():
        x[items.index(i), users.index(u)] = v
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    shared = (x > 0).astype(int) @ (x > 0).astype(int).T
    sim = np.round(x @ x.T, 6)
    out = set()
    for a, i in enumerate(items):
        near = sorted((-sim[a, b], j) for b, j in enumerate(items) if b != a and shared[a, b])[:k]
        out |= {(i, j, round(-s, 6), r + 1) for r, (s, j) in enumerate(near)}
    return out


def plays(case):
    rng = random.Random(case)
    if case == "hot user":  # one listener has heard all, many songs have no other listener
        rows = [("hot", f"s{i:03}", rng.randint(1, 500)) for i in range(120)]
        return rows + [(f"u{rng.randint(1, 9)}", f"s{rng.randint(0, 60):03}", rng.randint(1, 50)) for _ in range(150)]
    if case == "ties":
        return [(f"u{u}", f"s{i:02}", 1) for u in range(6) for i in range(40) if (u + i) % 3]
    if case == "skewed weights":
        return [(f"u{rng.randint(1, 12)}", f"s{rng.randint(0, 50):02}", int(10 ** rng.uniform(0, 6))) for _ in range(300)]
    return [("a", "x", 1), ("a", "x", 2), ("a", "y", 0), (None, "x", 3), ("b", None, 3), ("b", "x", None), ("a", "z", 2), ("c", "w", 5)]


@pytest.mark.parametrize("case", ["hot user", "ties", "skewed weights", "awkward"])
@pytest.mark.parametrize("k", [1, 4])
def test_neighbours_equal_brute_force(spark, case, k):
    rows = plays(case)
    df = spark.createDataFrame(rows, "user_id string, song_id string, play_count long")
    got = {tuple(r) for r in item_neighbours(df, k, block_rows=16).collect()}
    assert got == brute(rows, k)


def test_empty(spark):
    df = spark.createDataFrame([], "user_id string, song_id string, play_count long")
    assert item_neighbours(df).count() == 0


@pytest.mark.parametrize("case", ["hot user", "ties", "skewed weights"])
def test_neighbours_over_parts_and_batches(spark, case, monkeypatch):
    # several parts to merge, packed rows cut in slices, batches of few pairs
    rows = plays(case)
    monkeypatch.setattr(neighbours, "BATCH", 50)
    df = spark.createDataFrame(rows, "user_id string, song_id string, play_count long")
    got = {tuple(r) for r in item_neighbours(df, 4, block_rows=16, part_entries=60).collect()}
    assert got == brute(rows, 4)


@pytest.mark.parametrize("mostly", [0.0, 2.0])
def test_items_that_miss_entries_are_multiplied_out(mostly, monkeypatch):
    # 2.0: no item is taken as whole, every pair is looked up
    monkeypatch.setattr(neighbours, "MOSTLY", mostly)
    monkeypatch.setattr(neighbours, "BATCH", 70)
    rng = np.random.default_rng(3)
    x = np.where(rng.random((30, 12)) < 0.5, 10.0 ** rng.uniform(-3, 0, (30, 12)), 0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sim = x @ x.T
    np.fill_diagonal(sim, 0)
    i, u = np.nonzero(x)
    least = np.maximum(np.sort(sim, axis=1)[:, -3] - 2e-6, 0)
    found = list(neighbours._nearest((u, i, x[i, u], least[i]), (u, i, x[i, u]), 3, 0.25))
    got = {(a, b): s for f in found for a, b, s in zip(*(c.tolist() for c in f))}
    want = {(a, b): sim[a, b] for a in range(30) for b in np.lexsort((np.arange(30), -np.round(sim[a], 6)))[:3].tolist() if sim[a, b] > 0}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-6 for p in got)


def test_no_row_per_pair_is_shuffled(spark):
    # 60 items of one list have 3,540 pairs; packed, they are a few rows
    rows = [("u", f"s{i:02}", i + 1) for i in range(60)] + [("v", f"s{i:02}", 9) for i in range(40)]
    weights, _ = neighbours._weights(spark.createDataFrame(rows, "user_id string, song_id string, play_count long"), "user_id", "song_id", "play_count")
    dealt = neighbours._dealt(weights, neighbours._bounds(weights, 3), blocks=4, parts=2, block_rows=4096)
    assert dealt.count() == 2 * 4 * 2 + 2 * 2 * 4  # users x blocks x parts of asks, and of lists
