from fixtures_music import load
from pyspark.sql import functions as F

from listenlens.operators import themes


def test_theme_members_fixture(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    lex = themes.lexicon_df(spark, {"love": ["love", "heart"], "war": ["war"]})
    idx = themes.theme_index(lex, d["vocab"])
    scores = themes.theme_scores(d["lyrics"], idx.select("theme", "word_index"))
    members = {(r.track_id, r.theme) for r in themes.theme_members(scores, 0.063, 4).collect()}
    assert members == {("A", "love"), ("B", "war")}
    s = {(r.track_id, r.theme): (r.theme_score, r.total_words) for r in scores.collect()}
    assert s[("A", "love")] == (4, 15) and s[("B", "love")] == (3, 12) and s[("C", "love")] == (4, 100)
    assert s[("A", "war")] == (1, 15)


def test_one_plan_for_very_many_themes(spark):
    # 400 themes that share words; tracks without a theme word get no row
    lex = [(f"t{i}", w) for i in range(400) for w in (f"w{i % 50}", f"w{(i + 1) % 50}")]
    words = spark.createDataFrame(lex, "theme string, word string")
    post = [("A", "w0", 2), ("A", "w1", 1), ("A", "x", 7), ("B", "x", 3)]
    got = themes.theme_scores(spark.createDataFrame(post, "track_id string, word string, count long"), words, key="word").collect()
    want = {t: sum(c for _, w, c in post[:2] if (t, w) in set(lex)) for t, _ in lex}
    assert {(r.theme, r.theme_score, r.total_words) for r in got} == {(t, s, 10) for t, s in want.items() if s}


def test_vocabulary_size_and_unknown_expansion(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    assert themes.vocabulary_size(d["vocab"]).first()[0] == 5
    vectors = spark.createDataFrame([("love", [1.0, 0.0]), ("heart", [0.9, 0.1]), ("war", [0.0, 1.0])],
                                    "word string, vector array<double>")
    lex = themes.lexicon_df(spark, {"money": ["cash"]})
    out = themes.expand_lexicon(lex, vectors, 10, "theme")
    assert sorted(tuple(r) for r in out.collect()) == [("money", "cash")]  # no vector: nothing added
    lex2 = themes.lexicon_df(spark, {"love": ["heart"]})
    out2 = sorted(r.word for r in themes.expand_lexicon(lex2, vectors, 1, "theme").where(F.lit(True)).collect())
    assert out2 == ["heart"]  # nearest other word of "love" is heart, already a seed


def test_collections_dispatch(spark, tmpdir_path):
    import pytest
    d = load(spark, tmpdir_path)
    lex = themes.lexicon_df(spark, {"love": ["love", "heart"], "war": ["war"]})
    kw = dict(plays=d["plays"], tracks=d["tracks"], postings=d["lyrics"], vocabulary=d["vocab"],
              lexicon=lex, theme="love")
    base = themes.collections("baseline", **kw).collect()
    assert base == []  # lyrics ids A-D are not track ids of the play fixture
    with pytest.raises(ValueError):
        themes.collections("word2vec", **kw)
    with pytest.raises(ValueError):
        themes.collections("bogus", **kw)
    pred = spark.createDataFrame([("T1", "love"), ("T3", "war")], "track_id string, prediction string")
    out = themes.collections("classification", plays=d["plays"], tracks=d["tracks"], predictions=pred,
                             theme="love").collect()
    assert [(r.title, r.play_count) for r in out] == [("One", 21)]


def test_theme_scores_overlapping_words_brute_force(spark):
    import random
    rng = random.Random(9)
    words = [f"w{i}" for i in range(12)]
    lex = {"a": ["w0", "w1", "w2"], "b": ["w2", "w3"], "c": ["w3", "w4", "w0"]}
    post = [(f"t{t}", w, rng.randint(1, 5)) for t in range(20) for w in rng.sample(words, 5)]
    df = spark.createDataFrame(post, "track_id string, word string, count long")
    theme_words = spark.createDataFrame([(t, w) for t, ws in lex.items() for w in ws], "theme string, word string")
    got = {(r.track_id, r.theme): (r.theme_score, r.total_words)
           for r in themes.theme_scores(df, theme_words, key="word").collect()}
    expect = {}
    for t in {p[0] for p in post}:
        rows = [p for p in post if p[0] == t]
        total = sum(c for _, _, c in rows)
        for th, ws in lex.items():
            score = sum(c for _, w, c in rows if w in ws)
            if score > 0:
                expect[(t, th)] = (score, total)
    assert got == expect


def test_postings_are_not_dealt_by_word(spark):
    # nothing is known of the lexicon's size, as after an expansion, and small tables are not sent by Spark
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        post = spark.range(3000).selectExpr("cast(id % 300 as string) AS track_id", "if(id % 3 = 0, 'love', 'the') AS word", "1 AS count")
        scores = themes.theme_scores(post, themes.lexicon_df(spark, {"love": ["love", "heart"]}), key="word")
        plan = scores._jdf.queryExecution().executedPlan().toString()
        got = scores.select("theme_score", "total_words").distinct().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [tuple(r) for r in got] == [(10, 10)]
