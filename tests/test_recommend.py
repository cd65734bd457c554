import math

from fixtures_music import load
from pyspark.sql import functions as F

from listenlens.operators import content, evaluate, recommend, similarity
from listenlens.operators import interactions as ix


def test_item_cosine_all_data(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    sim = {(r.item_i, r.item_j): r.sim for r in similarity.item_cosine(d["plays"]).collect()}
    assert math.isclose(sim[("s1", "s2")], 0.468997, abs_tol=1e-6)
    assert math.isclose(sim[("s1", "s3")], 0.914457, abs_tol=1e-6)
    assert math.isclose(sim[("s2", "s3")], 0.082792, abs_tol=1e-6)
    # symmetric, self = 1
    for (i, j), v in sim.items():
        assert math.isclose(v, sim[(j, i)], abs_tol=1e-12)
    for i in ("s1", "s2", "s3"):
        assert math.isclose(sim[(i, i)], 1.0, abs_tol=1e-12)


def test_recommend_fixture_users(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    plays = d["plays"]
    sim = similarity.item_cosine(plays)
    recs = recommend.recommend_all(plays, sim, k=10)
    by_user = {}
    for r in recs.collect():
        by_user.setdefault(r.user_id, []).append((r.rank, r.song_id, r.score))
    assert by_user["u2"][0][1] == "s3" and math.isclose(by_user["u2"][0][2], 3.823414, abs_tol=1e-5)
    assert by_user["u3"][0][1] == "s2" and math.isclose(by_user["u3"][0][2], 6.455888, abs_tol=1e-5)
    assert "u1" not in by_user  # heard everything
    for user, want in (("nobody", []), ("u2", sorted(by_user["u2"]))):
        own = spark.createDataFrame([(user,)], "user_id string")
        got = recommend.recommend_user(plays, sim, own, k=10).collect()
        assert sorted((r.rank, r.song_id, r.score) for r in got) == want


def test_precision_divisor_is_k(spark):
    recs = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "c")], "user_id string, song_id string")
    test = spark.createDataFrame([("u", "a"), ("u", "z")], "user_id string, song_id string")
    assert math.isclose(evaluate.precision_at_k(recs, test, 10).first()[0], 0.1)


def test_user_profile(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    prof = content.user_profile(d["plays"], d["tracks"], d["genres"], user_id="u3", min_plays=10)
    assert [(r.track_id, r.artist, r.play_count, r.genre) for r in prof.collect()] == [
        ("T1", "Ann", 12, "Rock"), ("T3", "Ann", 10, "Rock")]


def test_holdout_invariants(spark):
    rows = [(f"u{n}", f"s{i}", 1 + i) for n in (4, 5, 10, 35) for i in range(n)]
    df = spark.createDataFrame(rows, "user_id string, song_id string, play_count int")
    split = ix.holdout_split(df, 0.2, 5, seed=42)
    sizes = {r.user_id: r.n for r in split.where(F.col("split") == "test").groupBy("user_id")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes.get("u4", 0) == 0 and sizes["u5"] == 1 and sizes["u10"] == 2 and sizes["u35"] == 7
    assert split.count() == df.count()  # train ∪ test = core, disjoint


def test_negative_samples(spark):
    rows = [("full", f"s{i}", 1) for i in range(4)] + [("half", "s0", 3), ("half", "s1", 2)]
    df = spark.createDataFrame(rows, "user_id string, song_id string, play_count int")
    out = ix.negative_samples(df, seed=42).collect()
    neg = [(r.user_id, r.song_id) for r in out if r.label == 0.0]
    assert not [u for u, _ in neg if u == "full"]  # heard every song: no negative
    seen = {(r[0], r[1]) for r in rows}
    assert len([1 for u, _ in neg if u == "half"]) == 2
    assert all((u, s) not in seen for u, s in neg)


def test_class_weights(spark):
    from listenlens.operators.classify import class_weights
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("b",)], "theme string")
    w = {r.theme: r.weight for r in class_weights(df).collect()}
    assert math.isclose(w["a"], 2.0) and math.isclose(w["b"], 2.0 / 3.0)
