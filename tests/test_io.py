import os
import time

from fixtures_music import load
from pyspark.sql import functions as F

from listenlens.operators import classify, content, themes
from listenlens.session import materialize
from listenlens.sources import english_stop_words, parse_lyrics_lines, read_theme_sets, train_word_vectors


def test_theme_set_roundtrip(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    lex = themes.lexicon_df(spark, {"love": ["love", "heart"], "war": ["war"]})
    members = themes.theme_members(themes.theme_scores(
        d["lyrics"], themes.theme_index(lex, d["vocab"]).select("theme", "word_index")), 0.063, 4)
    out = os.path.join(tmpdir_path, "sets")
    themes.save_theme_set(members, out)
    back = spark.read.parquet(out).select("track_id", "theme", "theme_ratio")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in members.collect())
    csv = os.path.join(tmpdir_path, "love.csv")
    with open(csv, "w") as f:
        f.write("A,love,0.2666\nB,war,0.75\n")
    assert read_theme_sets(spark, csv).count() == 2


def test_stop_words_and_word2vec(spark):
    stop = english_stop_words()
    assert "the" in stop and "i" in stop
    sents = spark.createDataFrame([(["love", "heart", "kiss"],), (["war", "fight", "gun"],)] * 5, "words array<string>")
    vec = train_word_vectors(sents, size=8, seed=42)
    assert vec.count() == 6 and len(vec.first().vector) == 8


def test_song_vectors_roundtrip(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    sv = content.song_vectors(content.artist_genre(d["tracks"], d["genres"]))
    out = os.path.join(tmpdir_path, "sv")
    content.save_song_vectors(sv, out)
    back = content.load_song_vectors(spark, out)
    assert back.count() == sv.count() == 6
    norms = back.groupBy("track_id", "genre").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert all(abs(r.n - 1.0) < 1e-12 for r in norms)


def test_classifier_fit_save_load(spark, tmpdir_path):
    from pyspark.ml.linalg import Vectors
    rows = [(f"t{i}", "a" if i % 3 else "b", Vectors.sparse(4, [i % 2, 2 + (i % 3 == 0)], [1.0, 2.0]))
            for i in range(30)]
    data = spark.createDataFrame(rows, ["track_id", "theme", "features"])
    model = classify.fit(data.select("track_id", "theme"), data.select("track_id", "features"), max_iter=20)
    path = os.path.join(tmpdir_path, "clf")
    classify.save_model(model, path)
    pred = classify.predict(classify.load_model(path), data.select("track_id", "theme"),
                            data.select("track_id", "features"))
    acc = pred.agg(F.avg((F.col("theme") == F.col("prediction")).cast("double"))).first()[0]
    assert acc > 0.9  # planted signal: feature 3 marks class b


def test_saving_one_theme_leaves_the_others(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "sets")
    rows = lambda *r: spark.createDataFrame(r, "track_id string, theme string, theme_ratio double")
    themes.save_theme_set(rows(("1", "a", 0.1), ("2", "a", 0.2)), out)
    themes.save_theme_set(rows(("1", "b", 0.3)), out)
    themes.save_theme_set(rows(("3", "a", 0.4)), out)
    assert sorted(map(tuple, themes.load_theme_set(spark, out).collect())) == [("1", "b", 0.3), ("3", "a", 0.4)]
    one = themes.load_theme_set(spark, out, "b")
    assert [tuple(r) for r in one.collect()] == [("1", "b", 0.3)]
    assert "PartitionFilters: [isnotnull(theme" in one._jdf.queryExecution().toString()


def test_chi_square_and_the_two_layer_model(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    docs = [(f"t{i}", "a" if i % 3 else "b", ["hit" if i % 3 == 0 else "miss"] * 2 + [f"w{j}" for j in rng.integers(0, 30, 12)])
            for i in range(90)]
    classes = spark.createDataFrame([d[:2] for d in docs], ["track_id", "theme"])
    words = spark.createDataFrame([(d[0], d[2]) for d in docs], ["track_id", "words"])
    long = words.select("track_id", F.explode("words").alias("word"), F.lit(1).alias("count"))
    got = {r.word: r.chi2 for r in classify.chi_square(long, classes).collect()}
    for word in {w for d in docs for w in d[2]}:
        seen = np.array([sum(d[2].count(word) for d in docs if d[1] == c) for c in "ab"], float)
        want = np.array([60, 30]) / 90 * seen.sum()
        assert abs(got[word] - ((seen - want) ** 2 / want).sum()) < 1e-9
    best = [r.word for r in classify.select_features(classify.chi_square(long, classes), 5).collect()]
    assert set(best[:2]) == {"hit", "miss"} and len(best) == 5
    vectors = classify.selected_vectors(words, best)
    model = classify.fit(classes, vectors, "mlp", max_iter=40)
    assert classify.predict(model, classes, vectors).where("theme = prediction").count() >= 88


def test_lyrics_line_is_cut_once(spark):
    # 40,000 postings in one line: cut for every posting, this took minutes
    n = 40_000
    line = spark.range(1).select(F.concat(F.lit("T1,0,"), F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat_ws(":", i.cast("string"), F.lit("2"))), ",")).alias("value"))
    began = time.time()
    got = parse_lyrics_lines(materialize(line)).agg(
        F.count("count"), F.sum("word_index"), F.min("track_id"), F.max("track_id")).first()
    assert tuple(got) == (n, n * (n + 1) // 2, "T1", "T1")
    assert time.time() - began < 30
