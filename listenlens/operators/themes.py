"""Lyric themes: lexicon, theme scores, members, theme charts
(S9, F4, F6, F7, J3, J10, A6, A13, T3, K1, P4, P5, P7).

A track belongs to a theme when ``theme words / all words > threshold`` and
``theme words >= min_words``; all words include stop words, theme words
never are stop words.  Scoring is a join of the postings with the theme-word
table, sent to the postings' tasks, plus map-side combined word counts, so hot
words do not skew it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listenlens.operators import charts
from listenlens.operators.vectors import similar_words
from listenlens.session import materialize

# The theme lexicon of the music workload (theme -> seed words).
THEMES = {
    "love": ["love", "heart", "kiss", "romance", "lover", "baby", "honey"],
    "war": ["war", "fight", "battle", "soldier", "gun", "blood"],
    "happiness": ["happy", "joy", "smile", "laugh", "celebration", "party"],
    "loneliness": ["lonely", "alone", "sad", "cry", "empty", "miss"],
    "money": ["money", "rich", "dollar", "gold", "cash", "wealth"],
}

# Thresholds of the current collections, and of the older ones.
THRESHOLD, MIN_WORDS, CHART_SIZE, TOP_N = 0.063, 4, 50, 10
OLDER_BASELINE = (0.065, 5)
OLDER_EXPANDED = (0.07, 5)

def lexicon_df(spark: SparkSession, themes: dict | None = None) -> DataFrame:
    """``(theme, word)`` rows of a theme dict."""
    themes = themes or THEMES
    rows = [(t, w) for t, words in themes.items() for w in words]
    return spark.createDataFrame(rows, "theme string, word string")


def theme_index(lexicon: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(theme, word, word_index)`` for lexicon words in the non-stop
    vocabulary; unknown words and stop words drop out."""
    vocab = vocabulary.where(~F.col("is_stop")).select("word", "word_index")
    lex = lexicon.select("theme", "word").distinct()
    return vocab.join(lex, "word").select("theme", "word", "word_index")


def theme_words(lexicon: DataFrame, stop_words) -> DataFrame:
    """J10 without a vocabulary table: ``(theme, word)`` minus stop words.

    Scoring by word needs no word index: a lexicon word that is not in the
    vocabulary has no postings, so dropping only the stop words gives the
    same theme sets as ``theme_index`` — without joining the corpus-sized
    vocabulary."""
    return lexicon.select("theme", "word").distinct().where(~F.col("word").isin([str(w) for w in stop_words]))


def vocabulary_size(vocabulary: DataFrame) -> DataFrame:
    """The largest index of a non-stop word."""
    return vocabulary.where(~F.col("is_stop")).agg(F.max("word_index").alias("vocabulary_size"))


def theme_scores(postings: DataFrame, theme_words: DataFrame, key: str = "word_index") -> DataFrame:
    """``(track_id, theme, theme_score, total_words, theme_ratio)``.

    ``postings``: ``(track_id, <key>, count)`` — a bag of words, or one row
    per token with ``count = 1``; ``theme_words``: ``(theme, <key>)`` (a set).
    Counts are summed per (track, set of themes of the word), combined on the map
    side, so a track leaves its task as a few sums: no posting is copied per theme.
    A track's sums then give its total and, unfolded, its theme scores.  One plan
    for any number of themes and words.  The word table is sent to every task: it is
    bounded by the lexicon, and dealing postings by word would sort all those of a
    word that every lyric holds in one task.  Only tracks with a theme word and a
    positive total get a row.
    """
    word_themes = theme_words.select("theme", key).distinct().groupBy(key).agg(
        F.array_sort(F.collect_set("theme")).alias("_themes"))
    sums = postings.join(F.broadcast(word_themes), key, "left").groupBy("track_id", "_themes").agg(F.sum("count").alias("_s"))
    per_track = sums.groupBy("track_id").agg(
        F.sum("_s").alias("total_words"),
        F.collect_list(F.when(F.col("_themes").isNotNull(), F.struct("_themes", "_s"))).alias("_t"))
    unfolded = (per_track.where((F.col("total_words") > 0) & (F.size("_t") > 0))
                .select("track_id", "total_words", F.inline("_t"))
                .select("track_id", "total_words", F.explode("_themes").alias("theme"), "_s"))
    return (unfolded.groupBy("track_id", "theme").agg(F.max("total_words").alias("total_words"), F.sum("_s").alias("theme_score"))
            .select("track_id", "theme", "theme_score", "total_words",
                    (F.col("theme_score") / F.col("total_words")).alias("theme_ratio")))


def theme_members(scores: DataFrame, threshold: float = THRESHOLD,
                  min_words: int = MIN_WORDS) -> DataFrame:
    """``ratio > threshold AND score >= min_words`` → ``(track_id, theme, theme_ratio)``."""
    return (scores.where((F.col("theme_ratio") > threshold) & (F.col("theme_score") >= min_words))
            .select("track_id", "theme", "theme_ratio"))


def theme_chart(plays: DataFrame, tracks: DataFrame, members: DataFrame,
                n: int = CHART_SIZE) -> DataFrame:
    """Top-``n`` tracks by plays of each theme:
    ``(theme, rank, artist, title, play_count)``."""
    # the few member tracks restrict tracks and plays before the totals: written
    # once, since finding them reads all lyrics
    members = materialize(members.select("track_id", "theme"))
    totals = charts.track_totals(plays, tracks, track_ids=members).join(members, "track_id")
    w = Window.partitionBy("theme").orderBy(F.desc("play_count"), F.asc("track_id"))
    return (totals.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .withColumn("rank", F.col("rank").cast("long"))
            .select("theme", "rank", "artist", "title", "play_count"))


def expand_lexicon(lexicon: DataFrame, vectors: DataFrame, top_n: int = TOP_N,
                   query: str = "theme") -> DataFrame:
    """P5/V2: add the ``top_n`` nearest words by vector cosine to each theme.

    ``query="theme"`` looks up the theme name itself (the workload's rule);
    ``query="seeds"`` looks up every seed word.  A query word without a
    vector adds nothing.
    """
    if query == "theme":
        asks = lexicon.select("theme", F.col("theme").alias("word")).distinct()
    elif query == "seeds":
        asks = lexicon.select("theme", "word").distinct()
    else:
        raise ValueError(f"unknown expansion query {query!r}")
    near = similar_words(vectors, asks.select("word"), top_n)
    added = asks.join(near, "word").select("theme", F.col("neighbor").alias("word"))
    # bounded by (lexicon words) × (1 + top_n); written once, read by several jobs
    return materialize(lexicon.select("theme", "word").unionByName(added).distinct())


def save_theme_set(members: DataFrame, path: str) -> None:
    """K1: persist theme members, one folder per theme.  The folders of the themes in
    ``members`` are replaced; other themes saved under ``path`` stay."""
    members.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("theme").parquet(path)


def load_theme_set(spark: SparkSession, path: str, theme: str | None = None) -> DataFrame:
    """K1: ``(track_id, theme, theme_ratio)`` as saved; of one ``theme`` only its folder is read."""
    # the schema is given: a partition column's type would be guessed from its names
    saved = spark.read.schema("track_id string, theme_ratio double, theme string").parquet(path)
    saved = saved if theme is None else saved.where(F.col("theme") == theme)
    return saved.select("track_id", "theme", "theme_ratio")


def collection(plays: DataFrame, tracks: DataFrame, postings: DataFrame, vocabulary: DataFrame,
               lexicon: DataFrame, theme: str, threshold: float = THRESHOLD,
               min_words: int = MIN_WORDS, vectors: DataFrame | None = None, top_n: int = TOP_N,
               expand_query: str = "theme", n: int = CHART_SIZE, key: str = "word_index") -> DataFrame:
    """Chart of one theme (``vectors`` given → embedding-expanded).

    ``postings`` are keyed by ``key``: ``word_index`` (lyrics files) or ``word``.
    """
    lex = lexicon.where(F.col("theme") == theme)
    if vectors is not None:
        lex = expand_lexicon(lex, vectors, top_n, expand_query)
    idx = theme_index(lex, vocabulary).select("theme", key)
    members = theme_members(theme_scores(postings, idx, key=key), threshold, min_words)
    return theme_chart(plays, tracks, members, n).drop("theme")


def collections(approach: str, **kw) -> DataFrame:
    """Dispatch ``baseline`` | ``word2vec`` | ``classification``.

    ``classification`` needs ``predictions`` (track_id, theme) from
    ``classify``; an unknown approach raises (the workload silently fell back
    to classification).
    """
    if approach == "baseline":
        kw.pop("vectors", None)
        return collection(**kw)
    if approach == "word2vec":
        if kw.get("vectors") is None:
            raise ValueError("word2vec approach needs a word-vector table")
        return collection(**kw)
    if approach == "classification":
        from listenlens.operators.classify import classified_chart
        return classified_chart(kw["plays"], kw["tracks"], kw["predictions"], kw["theme"],
                                kw.get("n", CHART_SIZE))
    raise ValueError(f"unknown approach {approach!r}")
