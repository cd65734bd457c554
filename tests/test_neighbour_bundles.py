"""Lists travel in bundles, for a few blocks of items at a time."""

import random

import numpy as np
import pytest

from listenlens.operators import neighbours


def plays(spark, users=40):
    rng = random.Random(21)
    rows = [(f"u{u:02}", f"s{i:02}", rng.randint(1, 9)) for u in range(users) for i in rng.sample(range(50), rng.randint(1, 25))]
    return rows, spark.createDataFrame(rows, "user_id string, song_id string, play_count long")


def brute(rows, k):
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    x = np.zeros((len(items), len(users)))
    for u, i, v in rows:
        x[items.index(i), users.index(u)] = v
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sim, shared = np.round(x @ x.T, 6), (x > 0).astype(int) @ (x > 0).astype(int).T
    return {(items[a], items[b]) for a in range(len(items))
            for b in sorted((b for b in range(len(items)) if b != a and shared[a, b]), key=lambda b: (-sim[a, b], b))[:k]}


@pytest.mark.parametrize("at_once", [1, 3, 100])
def test_blocks_in_turn(spark, monkeypatch, at_once):
    monkeypatch.setattr(neighbours, "BLOCKS_AT_ONCE", at_once)
    copied, real = [], neighbours._copies
    monkeypatch.setattr(neighbours, "_copies", lambda bundles, blocks, parts, first, last: copied.append((first, last)) or real(bundles, blocks, parts, first, last))
    rows, df = plays(spark)
    got = neighbours.item_neighbours(df, 3, part_entries=60, block_rows=30).collect()
    assert {(r["item_i"], r["item_j"]) for r in got} == brute(rows, 3) and len(got) == 150
    # every block once, few at a time
    assert [b for first, last in copied for b in range(first, last)] == list(range(copied[-1][1]))
    assert all(last - first <= at_once for first, last in copied) and copied[-1][1] >= 16


def test_bundles_hold_whole_lists(spark):
    rows, df = plays(spark)
    rows += [("alone", "s00", 1)]
    weights, _ = neighbours._weights(spark.createDataFrame(rows, df.schema), "user_id", "song_id", "play_count")
    bundles = neighbours._bundled(weights, neighbours._bounds(weights, 3), 30).collect()
    lists = [int(n) for b in bundles for n in np.bincount(np.cumsum(neighbours._unpacked(b["u"], np.int32))) if n]
    by_user = np.unique([r[0] for r in rows], return_counts=True)[1]
    assert sorted(lists) == sorted(n for n in by_user.tolist() if n > 1)  # one item alone has no partners
    assert len(bundles) < len(lists)
    bounds = {r["i"]: max(0.0, r["t"]) for r in neighbours._bounds(weights, 3).collect()}
    for b in bundles:  # bounds are stored shorter, never larger
        for i, t in zip(neighbours._unpacked(b["i"], np.int32).tolist(), neighbours._unpacked(b["t"], np.float32).tolist()):
            assert bounds.get(i, 0.0) - 1e-6 <= t <= bounds.get(i, 0.0)
