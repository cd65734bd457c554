import numpy as np

from listenlens.operators import blockmat, content, vectors


def _dense(rows, r_ids, c_ids):
    m = np.zeros((len(r_ids), len(c_ids)))
    ri = {v: i for i, v in enumerate(r_ids)}
    ci = {v: i for i, v in enumerate(c_ids)}
    for r, c, v in rows:
        m[ri[r], ci[c]] += v
    return m


def test_block_multiply_matches_numpy(spark):
    rng = np.random.default_rng(7)
    left = [(f"r{i}", f"k{j}", float(rng.integers(1, 5))) for i in range(23) for j in range(17)
            if rng.random() < 0.3]
    right = [(f"k{j}", f"c{c}", float(rng.integers(1, 5))) for j in range(17) for c in range(13)
             if rng.random() < 0.4]
    ldf = spark.createDataFrame(left, "r string, k string, v double")
    rdf = spark.createDataFrame(right, "k string, c string, v double")
    out = blockmat.multiply(ldf, rdf, lr="r", lk="k", lv="v", rk="k", rc="c", rv="v",
                            block_size=4, row_buckets=3).collect()
    r_ids = sorted({x[0] for x in left})
    k_ids = [f"k{j}" for j in range(17)]
    c_ids = sorted({x[1] for x in right})
    expect = _dense(left, r_ids, k_ids) @ _dense(right, k_ids, c_ids)
    got = np.zeros_like(expect)
    for r in out:
        got[r_ids.index(r.r), c_ids.index(r.c)] = r.value
    assert np.allclose(got, expect)


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ITEMS_PER_BLOCK", 7)
    monkeypatch.setattr(vectors, "QUERIES_PER_BUCKET", 5)
    rng = np.random.default_rng(3)
    items = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    df = spark.createDataFrame(items, "item_id long, vector array<double>")
    out = vectors.cosine_top_k(df.withColumnRenamed("item_id", "query_id"), df, 5,
                               exclude_self=True).collect()
    m = np.array([v for _, v in items])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    for q in range(40):
        cand = [i for i in range(40) if i != q]
        best = sorted(cand, key=lambda i: (-s[q, i], i))[:5]
        got = [r.item_id for r in sorted([r for r in out if r.query_id == q], key=lambda r: r.rank)]
        assert got == best


import pytest


@pytest.mark.parametrize("n_tracks", [120, 14])
def test_content_recommend_matches_brute_force(spark, n_tracks):
    # few artists crowding genres: exercises pruning, head and fallback paths;
    # the small catalogue has genres with fewer than k songs (zero-score fill)
    rng = np.random.default_rng(11)
    cat = [(f"t{i:03d}", f"g{rng.integers(0, 3)}", f"a{rng.integers(0, 4)}") for i in range(n_tracks)]
    prof = [(f"u{u}", t, a, 10, g) for u in range(12)
            for (t, g, a) in [cat[j] for j in rng.choice(n_tracks, size=int(rng.integers(1, 6)), replace=False)]]
    cdf = spark.createDataFrame(cat, "track_id string, genre string, artist string")
    pdf = spark.createDataFrame(prof, "user_id string, track_id string, artist string, play_count int, genre string")
    got = {}
    for r in content.recommend(pdf, cdf, 10).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.track_id, r.genre, r.score))
    for u in {p[0] for p in prof}:
        rows = [p for p in prof if p[0] == u]
        cnt = {}
        for _, _, a, _, g in rows:
            cnt["a=" + a] = cnt.get("a=" + a, 0) + 1
            cnt["g=" + g] = cnt.get("g=" + g, 0) + 1
        norm = np.sqrt(sum(c * c for c in cnt.values()))
        scored = [(round((cnt.get("a=" + a, 0) + cnt.get("g=" + g, 0)) / norm / np.sqrt(2), 6), t, g)
                  for t, g, a in cat]
        best = sorted(scored, key=lambda x: (-x[0], x[1], x[2]))[:10]
        mine = [(t, g) for _, t, g, _ in sorted(got[u])]
        assert mine == [(t, g) for _, t, g in best], u


@pytest.mark.parametrize("most_sent", [content.MOST_SENT, 0])
def test_content_recommend_writes_no_row_per_pair(spark, monkeypatch, most_sent):
    # every user has 8 artists of 6 genres each, all pairs hold k songs
    written = []

    def keep(df):
        out = df.localCheckpoint()
        written.append(out.selectExpr("sum(size(pairs))").first()[0] if "pairs" in out.columns else out.count())
        return out
    monkeypatch.setattr(content, "materialize", keep)
    monkeypatch.setattr(content, "MOST_SENT", most_sent)
    cat = [(f"t{i:03d}", f"g{i % 6}", f"a{i // 6 % 8}") for i in range(480)]
    rng = np.random.default_rng(5)
    prof = [(f"u{u:02d}", t, a, 10, g) for u in range(40) for i in range(8)
            for (t, g, a) in [cat[48 * int(rng.integers(0, 10)) + 6 * i + int(rng.integers(0, 6))]]]
    prof += [(f"u{u:02d}", "x", f"a{u % 8}", 10, f"g{u % 6}") for u in range(40)]
    cdf = spark.createDataFrame(cat, "track_id string, genre string, artist string")
    pdf = spark.createDataFrame(prof, "user_id string, track_id string, artist string, play_count int, genre string")
    got = {}
    for r in content.recommend(pdf, cdf, 10).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.track_id, r.score))
    assert max(written) <= len(cat) < 40 * 8 * 6  # a row per user, artist and genre before
    for u in {p[0] for p in prof}:
        cnt = {}
        for _, _, a, _, g in [p for p in prof if p[0] == u]:
            cnt[a], cnt[g] = cnt.get(a, 0) + 1, cnt.get(g, 0) + 1
        norm = np.sqrt(sum(c * c for c in cnt.values()))
        scored = sorted((-round((cnt.get(a, 0) + cnt.get(g, 0)) / norm / np.sqrt(2), 6), t) for t, g, a in cat)
        assert [(t, s) for _, t, s in sorted(got[u])] == [(t, -s) for s, t in scored[:10]], u
