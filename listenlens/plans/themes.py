"""Named theme queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from listenlens.operators import themes
from listenlens.plans.registry import register
from listenlens.plans.sql import english_stop_words_sql, with_ctes
from listenlens.session import materialize, shared_path
from listenlens.sources import (
    english_stop_words, parse_lyrics_lines, parse_vocabulary_line, read_theme_sets, star,
)


def theme_sql(lexicon_cte: str = "lexicon") -> dict[str, str]:
    """Theme CTEs over a lexicon CTE (the seeds or an expanded one)."""
    return {
        "theme_idx": f"""
            SELECT l.theme, v.word, v.word_index
            FROM (SELECT DISTINCT theme, word FROM {lexicon_cte}) l JOIN vocab v ON l.word = v.word
            WHERE NOT v.is_stop""",
        "tscores": """
            SELECT h.track_id, h.theme, h.theme_score, t.total_words,
                   h.theme_score / t.total_words AS theme_ratio
            FROM (SELECT p.track_id, ti.theme, CAST(sum(p.count) AS BIGINT) AS theme_score
                  FROM postings p JOIN (SELECT DISTINCT theme, word FROM theme_idx) ti ON p.word = ti.word
                  GROUP BY p.track_id, ti.theme) h
            JOIN (SELECT track_id, CAST(sum(count) AS BIGINT) AS total_words FROM postings
                  GROUP BY track_id HAVING sum(count) > 0) t ON h.track_id = t.track_id""",
        "members": """
            SELECT track_id, theme, theme_ratio FROM tscores
            WHERE theme_ratio > 0.063 AND theme_score >= 4""",
        "tchart": """
            SELECT theme, rank, artist, title, play_count FROM (
                SELECT m.theme, tt.artist, tt.title, tt.play_count,
                       row_number() OVER (PARTITION BY m.theme ORDER BY tt.play_count DESC, tt.track_id) AS rank
                FROM track_totals tt JOIN members m ON tt.track_id = m.track_id)
            WHERE rank <= 50""",
    }


BASE = ["vocab", "lexicon", "track_totals"]


def _scores(spark, d, lexicon=None):
    lex = lexicon if lexicon is not None else star.theme_lexicon(spark)
    # score on words directly: no vocabulary index, no join of all postings
    # with the vocabulary (same theme sets, see themes.theme_words)
    words = themes.theme_words(lex, star.ADAPTER_STOP_WORDS)
    # one row per token (count 1): no (track, word) aggregation is needed
    scores = themes.theme_scores(star.token_rows(spark, d), words, key="word")
    return scores.withColumn("track_id", F.col("track_id").cast("string"))


@register("vocabulary", ids="S6 X5 X7", sql=with_ctes(["vocab"], "SELECT * FROM vocab"))
def vocabulary(spark, d):
    return star.vocabulary(spark, d)


@register("vocabulary_size", ids="A13", sql=with_ctes(["vocab"], """
    SELECT max(word_index) AS vocabulary_size FROM vocab WHERE NOT is_stop"""))
def vocabulary_size(spark, d):
    return themes.vocabulary_size(star.vocabulary(spark, d))


@register("lyrics_postings", ids="S5 X6", sql=with_ctes(["vocab"], """
    SELECT p.track_id, v.word_index, p.count FROM postings p JOIN vocab v ON p.word = v.word"""))
def lyrics_postings(spark, d):
    return star.indexed_postings(spark, d)


@register("theme_index", ids="J10 S9 F4", sql=with_ctes(BASE, "SELECT * FROM theme_idx", theme_sql()))
def theme_index(spark, d):
    return themes.theme_index(star.theme_lexicon(spark), star.vocabulary(spark, d))


@register("theme_scores", ids="A6 F6 X8", sql=with_ctes(BASE, "SELECT * FROM tscores", theme_sql()))
def theme_scores(spark, d):
    return _scores(spark, d)


@register("theme_members", ids="F7", sql=with_ctes(BASE, "SELECT * FROM members", theme_sql()))
def theme_members(spark, d):
    return themes.theme_members(_scores(spark, d), 0.063, 4)


@register("theme_chart", ids="P4 J3 T3", sql=with_ctes(BASE, "SELECT * FROM tchart", theme_sql()))
def theme_chart(spark, d):
    members = themes.theme_members(_scores(spark, d), 0.063, 4)
    return themes.theme_chart(star.triplets(spark, d), star.tracks(spark, d), members, 50)



@register("theme_collection", ids="P7 P4", sql=with_ctes(BASE, """
    SELECT artist, title, play_count FROM tchart WHERE theme = 'love'""", theme_sql()))
def theme_collection(spark, d):
    # the one-theme API of the workload, dispatched by approach
    return _love(spark, d, "baseline", lexicon=star.theme_lexicon(spark))


def _love(spark, d, approach, **kw):
    return themes.collections(
        approach, plays=star.triplets(spark, d), tracks=star.tracks(spark, d),
        postings=star.token_rows(spark, d).withColumn("track_id", F.col("track_id").cast("string")),
        vocabulary=star.vocabulary(spark, d), theme="love", key="word", **kw).select("artist", "title", "play_count")


@register("vocabulary_line_parse", ids="S6 X5 X7", sql=with_ctes(["header"], """
    SELECT word_index, CASE WHEN word_index = 1 THEN 'i' ELSE word END AS word,
           CASE WHEN word_index = 1 THEN false
                ELSE word IN ('the', 'of', 'and', 'to', 'a', 'in', 'is', 'that') END AS is_stop FROM header"""))
def vocabulary_line_parse(spark, d):
    return parse_vocabulary_line(star.vocabulary_lines(spark, d), star.ADAPTER_STOP_WORDS)


@register("lyrics_lines_parse", ids="S5 X5 X6", sql=with_ctes(["vocab"], """
    SELECT p.track_id, v.word_index, CAST(p.count AS INTEGER) AS count FROM postings p JOIN vocab v ON p.word = v.word"""))
def lyrics_lines_parse(spark, d):
    return parse_lyrics_lines(star.lyrics_lines(spark, d))


@register("theme_set_roundtrip", ids="K1", sql=with_ctes(BASE, "SELECT * FROM members", theme_sql()))
def theme_set_roundtrip(spark, d):
    # theme by theme, one of them twice: each save replaces its own theme only
    path = shared_path(spark, "theme-sets")
    members = materialize(themes.theme_members(_scores(spark, d), 0.063, 4))
    for theme in [*star.ADAPTER_THEMES, next(iter(star.ADAPTER_THEMES))]:
        themes.save_theme_set(members.where(F.col("theme") == theme), path)
    return themes.load_theme_set(spark, path)


@register("theme_set_load", ids="K1", sql=with_ctes(BASE, "SELECT * FROM members WHERE theme = 'war'", theme_sql()))
def theme_set_load(spark, d):
    # one theme's folder of the saved sets
    path = shared_path(spark, "theme-sets")
    themes.save_theme_set(themes.theme_members(_scores(spark, d), 0.063, 4), path)
    return themes.load_theme_set(spark, path, "war")


@register("theme_set_csv", ids="S7", sql=with_ctes(BASE, """
    SELECT track_id, theme, round(theme_ratio, 9) AS theme_ratio FROM members""", theme_sql()))
def theme_set_csv(spark, d):
    # the headerless files of the workload, written and read by the reader
    path = shared_path(spark, "theme-csv")
    themes.theme_members(_scores(spark, d), 0.063, 4).select("track_id", "theme", "theme_ratio").write.csv(path)
    return read_theme_sets(spark, path).withColumn("theme_ratio", F.round("theme_ratio", 9))


@register("english_stop_vocabulary", ids="S10 S6", sql=with_ctes(["postings"], f"""
    SELECT CAST(row_number() OVER (ORDER BY word) AS INTEGER) AS word_index, word,
           word IN ({english_stop_words_sql()}) AS is_stop
    FROM (SELECT DISTINCT word FROM postings)"""))
def english_stop_vocabulary(spark, d):
    # the vocabulary with Spark's English stop-word list instead of the adapter's
    return star.vocabulary(spark, d, stop_words=english_stop_words())
