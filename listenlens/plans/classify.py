"""Named classifier queries.

Adapter: the class of a document is ``labels.quality``; the theme sets of the
union step are the embedding-expanded theme members.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from listenlens.operators import classify, evaluate, themes
from listenlens.plans.registry import register
from listenlens.plans.sql import with_ctes
from listenlens.plans.themes import BASE, _scores, theme_sql
from listenlens.plans.vectors import NEAR, XLEX
from listenlens.session import materialize, shared_path
from listenlens.sources import star

LAB = {
    "lab": "SELECT CAST(doc_id AS VARCHAR) AS track_id, CAST(quality AS VARCHAR) AS theme FROM labels",
    "strat": """
        SELECT track_id, theme,
               CASE WHEN rn <= floor(nc * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY theme
                                           ORDER BY md5(track_id || ':' || theme || ':42'), track_id) AS rn,
                     count(*) OVER (PARTITION BY theme) AS nc
              FROM lab)""",
}


def labelled(spark, d):
    return star.document_labels(spark, d).withColumnRenamed("label", "theme")


def split(spark, d):
    return classify.stratified_split(labelled(spark, d), "theme", 0.2, seed=42)


def _expanded_members(spark, d):
    lex = themes.expand_lexicon(star.theme_lexicon(spark), star.word_vectors(spark, d), 10, "seeds")
    return themes.theme_members(_scores(spark, d, lex), 0.063, 4)


@register("training_set", ids="U1 A16", sql=with_ctes(
    BASE + ["word_vectors"], "SELECT DISTINCT track_id, theme, theme_ratio FROM members",
    {**NEAR, **XLEX, **theme_sql("xlex")}))
def training_set(spark, d):
    # all themes' sets in one table: the texts are read once
    return classify.training_set(_expanded_members(spark, d))


@register("stratified_split", ids="D2 T9", sql=with_ctes([], "SELECT * FROM strat", LAB))
def stratified_split(spark, d):
    return split(spark, d)


@register("class_weights", ids="A11", sql=with_ctes([], """
    SELECT theme, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight
    FROM (SELECT theme, count(*) AS n_c FROM strat WHERE split = 'train' GROUP BY theme)""", LAB))
def class_weights(spark, d):
    train = split(spark, d).where(F.col("split") == "train")
    return classify.class_weights(train).withColumn("weight", F.round("weight", 6))


@register("bow_features", ids="D8 J11", sql=with_ctes(["vocab"], """
    SELECT p.track_id, v.word_index, p.count
    FROM postings p JOIN vocab v ON p.word = v.word
    WHERE NOT v.is_stop AND p.track_id IN (SELECT track_id FROM lab)""", LAB))
def bow_features(spark, d):
    vocab = star.vocabulary(spark, d)
    return classify.bow_features(star.indexed_postings(spark, d, vocab), vocab, labelled(spark, d))


@register("bow_features_split", ids="D8 J11 S5", sql=with_ctes(["vocab"], """
    SELECT p.track_id, v.word_index, p.count
    FROM postings p JOIN vocab v ON p.word = v.word
    WHERE NOT v.is_stop AND p.track_id IN (SELECT track_id FROM lab)""", LAB))
def bow_features_split(spark, d):
    words = materialize(star.postings(spark, d))  # the texts are tokenised once, for the vocabulary and the rows
    vocab = star.vocabulary(spark, d, rows=words)
    # documents without a label go before the joins with words that most documents hold
    tracks = labelled(spark, d)
    wanted = materialize(words.join(tracks.select("track_id").distinct(), "track_id", "left_semi"))
    rows = materialize(star.indexed_postings(spark, d, vocab, split=True, rows=wanted))
    return classify.bow_features(rows, vocab, tracks, split=True)


def _model(spark, d):
    """The fitted model and the written feature vectors of all documents: texts are
    tokenised once, for fitting and prediction alike."""
    vectors = materialize(classify.hashed_vectors(star.word_lists(spark, d)))
    parts = split(spark, d)
    return classify.fit(parts.where(F.col("split") == "train"), vectors, "logistic", max_iter=50), vectors, parts


def _predictions(spark, d):
    model, vectors, parts = _model(spark, d)
    return classify.predict(model, parts.where(F.col("split") == "test"), vectors)


@register("theme_classifier", ids="M1")
def theme_classifier(spark, d):
    return _predictions(spark, d)


@register("model_roundtrip", ids="K2 M1")
def model_roundtrip(spark, d):
    # the model and the split are saved, loaded and then applied
    model, vectors, parts = _model(spark, d)
    path = shared_path(spark, "theme-model")
    classify.save_model(model, f"{path}/model")
    classify.save_split(parts, f"{path}/split")
    test = classify.load_split(spark, f"{path}/split").where(F.col("split") == "test")
    return classify.predict(classify.load_model(f"{path}/model"), test, vectors)


CHI_WORDS = 200


def _chi_square(parts, lists):
    train = parts.where(F.col("split") == "train").select("track_id", "theme")
    # only the training documents' lists are unfolded
    words = lists.join(train.select("track_id"), "track_id", "left_semi").select(
        "track_id", F.explode("words").alias("word"), F.lit(1).alias("count"))
    return classify.select_features(classify.chi_square(words, train), CHI_WORDS)


@register("chi_square_words", ids="M1 D8", sql=with_ctes(["tokens"], f"""
    SELECT word, round(sum(o * o / p) / sum(o) - sum(o), 6) AS chi2 FROM (
        SELECT k.word, t.theme, CAST(count(*) AS DOUBLE) AS o FROM tokens k
        JOIN (SELECT * FROM strat WHERE split = 'train') t ON k.track_id = t.track_id
        WHERE k.word NOT IN ('the', 'of', 'and', 'to', 'a', 'in', 'is', 'that') GROUP BY k.word, t.theme)
    JOIN (SELECT theme, count(*) / sum(count(*)) OVER () AS p FROM strat WHERE split = 'train' GROUP BY theme) USING (theme)
    GROUP BY word ORDER BY chi2 DESC, word LIMIT {CHI_WORDS}""", LAB))
def chi_square_words(spark, d):
    return _chi_square(split(spark, d), star.word_lists(spark, d, ids=labelled(spark, d)))


@register("mlp_classifier", ids="M1 D8")
def mlp_classifier(spark, d):
    # the two-layer model on the words that tell the classes apart
    parts = materialize(split(spark, d))  # read by the selection, the fit and the prediction
    # texts are tokenised once; documents without a label are in neither split
    lists = materialize(star.word_lists(spark, d, ids=parts))
    vocabulary = [r["word"] for r in _chi_square(parts, lists).orderBy(F.desc("chi2"), "word").collect()]  # CHI_WORDS at most
    vectors = materialize(classify.selected_vectors(lists, vocabulary))
    model = classify.fit(parts.where(F.col("split") == "train"), vectors, "mlp", max_iter=60)
    return classify.predict(model, parts.where(F.col("split") == "test"), vectors)


@register("split_roundtrip", ids="K2", sql=with_ctes([], "SELECT * FROM strat", LAB))
def split_roundtrip(spark, d):
    path = shared_path(spark, "split")
    classify.save_split(split(spark, d), path)
    return classify.load_split(spark, path)


@register("model_theme_chart", ids="P6 M1")
def model_theme_chart(spark, d):
    # from the texts to the chart: the classes are the model's
    model, vectors, parts = _model(spark, d)
    pred = classify.predict(model, parts, vectors).select("track_id", "prediction")
    return classify.classified_chart(star.triplets(spark, d), star.tracks(spark, d), pred, None, 50)


@register("classifier_accuracy", ids="M1 A12")
def classifier_accuracy(spark, d):
    return evaluate.accuracy(_predictions(spark, d), label="theme", prediction="prediction")


@register("accuracy", ids="A12", sql="""
    SELECT avg(CASE WHEN toxic = quality THEN 1.0 ELSE 0.0 END) AS accuracy FROM labels""")
def accuracy(spark, d):
    # a given prediction table: `toxic` taken as the predicted `quality`
    lab = star.table(spark, d, "labels")
    return evaluate.accuracy(lab, label="quality", prediction="toxic")


@register("classified_theme_chart", ids="P6 J3 T3", sql=with_ctes(["track_totals"], """
    SELECT theme, rank, artist, title, play_count FROM (
        SELECT l.theme, tt.artist, tt.title, tt.play_count,
               row_number() OVER (PARTITION BY l.theme ORDER BY tt.play_count DESC, tt.track_id) AS rank
        FROM track_totals tt JOIN lab l ON tt.track_id = l.track_id)
    WHERE rank <= 50""", LAB))
def classified_theme_chart(spark, d):
    # the given predictions: each labelled document's quality class
    pred = labelled(spark, d).select("track_id", F.col("theme").alias("prediction"))
    return classify.classified_chart(star.triplets(spark, d), star.tracks(spark, d), pred, None, 50)


@register("theme_collection_classified", ids="P7 P6", sql=with_ctes(["track_totals"], """
    SELECT tt.artist, tt.title, tt.play_count FROM track_totals tt JOIN lab l ON tt.track_id = l.track_id
    WHERE l.theme = '1' ORDER BY tt.play_count DESC, tt.track_id LIMIT 50""", LAB))
def theme_collection_classified(spark, d):
    pred = labelled(spark, d).select("track_id", F.col("theme").alias("prediction"))
    return themes.collections("classification", plays=star.triplets(spark, d), tracks=star.tracks(spark, d),
                              predictions=pred, theme="1", n=50).select("artist", "title", "play_count")
