from listenlens.operators import content, interactions, recommend, similarity, themes


def test_empty_training_gives_no_recommendations(spark):
    train = spark.createDataFrame([], "user_id string, song_id string, play_count double")
    items = spark.createDataFrame([("s1",), ("s2",)], "song_id string")
    recs = recommend.recommend_all(train, similarity.item_cosine(train), items=items, k=10)
    assert recs.count() == 0


def test_empty_lexicon_scores_nothing(spark):
    postings = spark.createDataFrame([("A", "love", 3)], "track_id string, word string, count long")
    words = spark.createDataFrame([], "theme string, word string")
    out = themes.theme_scores(postings, words, key="word")
    assert out.count() == 0
    assert out.columns == ["track_id", "theme", "theme_score", "total_words", "theme_ratio"]


def test_empty_catalogue_or_profile_recommends_nothing(spark):
    profile = spark.createDataFrame([("u", "t1", "a", 12, "g")], "user_id string, track_id string, artist string, play_count int, genre string")
    catalogue = spark.createDataFrame([("t1", "g", "a")], "track_id string, genre string, artist string")
    assert content.recommend(profile, catalogue.limit(0), 10).count() == 0
    assert content.recommend(profile.limit(0), catalogue, 10).count() == 0
    assert [r.track_id for r in content.recommend(profile, catalogue, 10).collect()] == ["t1"]


def test_pivot_takes_its_columns(spark):
    rows = spark.createDataFrame([("u", "a", 2), ("u", "a", 4), ("v", "b", 1)], "user_id string, song_id string, play_count int")
    got = {r.user_id: (r.a, r.b, r.c) for r in interactions.pivot(rows, ["a", "b", "c"]).collect()}
    assert got == {"u": (3.0, 0.0, 0.0), "v": (0.0, 1.0, 0.0)}
