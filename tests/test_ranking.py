"""Pairwise-ranking factors: negatives, one step by brute force, a planted signal."""

import numpy as np
from pyspark.sql import functions as F

from listenlens.operators import ranking

SCHEMA = "user_id string, song_id string, play_count double"


def planted():
    """Two tastes; a user misses some items of the own taste.  Two items of the
    other taste are the most heard of all."""
    rows = [(f"u{u:02}", f"i{i:02}", 1.0) for u in range(40) for i in range(24) if i % 2 == u % 2 and (u * 7 + i * 3) % 5]
    return rows + [(f"v{u:02}", f"i{i:02}", 1.0) for u in range(30) for i in (0, 1)]


def test_negatives_are_unheard_items_of_the_same_block(spark):
    rows = planted() + [("all", f"i{i:02}", 1.0) for i in range(24)]
    df = spark.createDataFrame(rows, SCHEMA)
    items = ranking.dealt(df, "song_id", 3)
    heard = df.join(items, "song_id").select("user_id", "song_id", "block", "place")
    name = {(r["block"], r["place"]): r["song_id"] for r in items.collect()}
    block = {i: b for (b, _), i in name.items()}
    assert all(sorted(p for b, p in name if b == x) == list(range(sum(b == x for b, _ in name))) for x in range(3))
    got = ranking.block_negatives(heard, items).collect()
    pairs = {(u, i) for u, i, _ in rows}
    assert all((r["user_id"], name[r["block"], r["place"]]) in pairs for r in got)
    assert all((r["user_id"], name[r["block"], r["other"]]) not in pairs for r in got)
    size = {b: sum(x == b for x in block.values()) for b in range(3)}
    full = {(u, b) for u, _ in pairs for b in size if sum((u, i) in pairs for i in block if block[i] == b) == size[b]}
    want = sorted((u, i) for u, i in pairs if (u, block[i]) not in full)
    assert sorted((r["user_id"], name[r["block"], r["place"]]) for r in got) == want


def test_one_step_equals_brute_force(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    p, q = ranking.fit(df, rank=3, epochs=1, blocks=1, draws=1, batch=10_000, rate=0.2, reg=0.05)
    users, items = ranking.dealt(df, "user_id", 1), ranking.dealt(df, "song_id", 1)
    rows = df.select("user_id", "song_id").distinct()
    three = [(r["u"], r["i"], r["j"]) for r in ranking.triples(rows, users, items, 1, 1).collect()]
    first = [{r["place"]: np.array(r["v"]) for r in ranking.first_factors(t, c, 3).collect()}
             for t, c in ((users, "user_id"), (items, "song_id"))]
    up = [{k: [] for k in side} for side in first]
    for u, i, j in three:
        a, b, c = first[0][u], first[1][i], first[1][j]
        g = 1 / (1 + np.exp(a @ (b - c)))
        up[0][u].append(g * (b - c) - 0.05 * a)
        up[1][i].append(g * a - 0.05 * b)
        up[1][j].append(-g * a - 0.05 * c)
    for fitted, ids, key, old, moves in ((p, users, "user_id", first[0], up[0]), (q, items, "song_id", first[1], up[1])):
        place = {r[key]: r["place"] for r in ids.collect()}
        for r in fitted.collect():
            n = place[r[key]]
            want = old[n] + (0.2 * np.mean(moves[n], axis=0) if moves[n] else 0)
            assert np.allclose(r["v"], want, atol=1e-12)


def test_planted_tastes_beat_popularity(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    p, q = ranking.fit(df, rank=4, epochs=12, blocks=2, batch=32, rate=0.5)
    recs = ranking.recommend(p, q, df, 2).where(F.col("user_id").startswith("u"))
    same = F.substring("user_id", 2, 2).cast("int") % 2 == F.substring("song_id", 2, 2).cast("int") % 2
    total = recs.count()
    assert total == 80 and recs.join(df, ["user_id", "song_id"]).count() == 0
    own = recs.where(same).count() / total
    heard = df.groupBy("song_id").count().collect()
    order = [r["song_id"] for r in sorted(heard, key=lambda r: (-r["count"], r["song_id"]))]
    pairs = {(u, i) for u, i, _ in planted()}
    popular = [(u, [i for i in order if (u, i) not in pairs][:2]) for u in {u for u, _, _ in planted() if u[0] == "u"}]
    by_count = np.mean([int(u[1:]) % 2 == int(i[1:]) % 2 for u, two in popular for i in two])
    assert own > 0.85 and own > by_count + 0.2


def test_empty(spark):
    p, q = ranking.fit(spark.createDataFrame([], SCHEMA), epochs=1, blocks=2)
    assert p.count() == q.count() == 0
