"""Named content-based queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from listenlens.functions import label_codes as codes
from listenlens.operators import content
from listenlens.operators import interactions as ix
from listenlens.operators import lookup
from listenlens.plans.registry import register
from listenlens.plans.sql import with_ctes
from listenlens.session import shared_path
from listenlens.sources import star

K = 10

CONTENT = {
    "prof": """
        SELECT p.user_id, t.track_id, t.artist, p.play_count, g.genre
        FROM triplets p JOIN tracks t ON p.song_id = t.song_id JOIN genres g ON t.track_id = g.track_id
        WHERE p.play_count >= 10""",
    "ag": "SELECT t.track_id, g.genre, t.artist FROM tracks t JOIN genres g ON t.track_id = g.track_id",
    "feat": """
        SELECT user_id, 'artist=' || artist AS feature FROM prof
        UNION ALL SELECT user_id, 'genre=' || genre AS feature FROM prof""",
    "cnt": "SELECT user_id, feature, count(*) AS c FROM feat GROUP BY user_id, feature",
    "taste": """
        SELECT c.user_id, c.feature, c.c / n.n AS weight
        FROM cnt c JOIN (SELECT user_id, sqrt(sum(c * c)) AS n FROM cnt GROUP BY user_id) n
          ON c.user_id = n.user_id""",
    "csc": """
        SELECT u.user_id, ag.track_id, ag.genre, ag.artist,
               round((coalesce(ta.weight, 0) + coalesce(tg.weight, 0)) / sqrt(2), 6) AS score
        FROM (SELECT DISTINCT user_id FROM prof) u CROSS JOIN ag
        LEFT JOIN taste ta ON ta.user_id = u.user_id AND ta.feature = 'artist=' || ag.artist
        LEFT JOIN taste tg ON tg.user_id = u.user_id AND tg.feature = 'genre=' || ag.genre""",
}


def csql(body: str) -> str:
    return with_ctes(["triplets", "tracks", "genres"], body, CONTENT)


def _profile(spark, d):
    return content.user_profile(star.triplets(spark, d), star.tracks(spark, d), star.genres(spark, d),
                                min_plays=10)


@register("artists", ids="A5", sql=with_ctes(["tracks"], "SELECT DISTINCT artist FROM tracks"))
def artists(spark, d):
    return content.artists(star.tracks(spark, d))


@register("artist_genre", ids="J7", sql=csql("SELECT * FROM ag"))
def artist_genre(spark, d):
    return content.artist_genre(star.tracks(spark, d), star.genres(spark, d))


@register("user_profile", ids="P12 F5 J6", sql=csql("SELECT * FROM prof"))
def user_profile(spark, d):
    return _profile(spark, d)


@register("song_vectors", ids="M6", sql=csql("""
    SELECT track_id, genre, 'artist=' || artist AS feature, round(1 / sqrt(2), 6) AS weight FROM ag
    UNION ALL
    SELECT track_id, genre, 'genre=' || genre AS feature, round(1 / sqrt(2), 6) AS weight FROM ag"""))
def song_vectors(spark, d):
    rows = content.artist_genre(star.tracks(spark, d), star.genres(spark, d))
    return content.song_vectors(rows).withColumn("weight", F.round("weight", 6))


@register("taste_vector", ids="A14 A15", sql=csql(
    "SELECT user_id, feature, round(weight, 6) AS weight FROM taste"))
def taste_vector(spark, d):
    return content.taste_vector(_profile(spark, d)).withColumn("weight", F.round("weight", 6))


@register("content_recommend", ids="P13 V1", sql=csql(f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, track_id, genre) AS rank
        FROM csc)
    WHERE rank <= {K}"""))
def content_recommend(spark, d):
    catalogue = content.artist_genre(star.tracks(spark, d), star.genres(spark, d))
    return content.recommend(_profile(spark, d), catalogue, K)


@register("label_codes", ids="D4 A4 A5", sql=with_ctes(["tracks", "genres"], """
    SELECT 'artist' AS kind, artist AS value, dense_rank() OVER (ORDER BY artist) - 1 AS code
    FROM (SELECT DISTINCT artist FROM tracks)
    UNION ALL
    SELECT 'genre' AS kind, genre AS value, dense_rank() OVER (ORDER BY genre) - 1 AS code
    FROM (SELECT DISTINCT genre FROM genres)"""))
def label_codes(spark, d):
    # the artist and genre encoders of the song-vector step
    a = codes(star.tracks(spark, d), "artist", "code").select(F.lit("artist").alias("kind"),
                                                               F.col("artist").alias("value"), "code")
    g = codes(star.genres(spark, d), "genre", "code").select(F.lit("genre").alias("kind"),
                                                              F.col("genre").alias("value"), "code")
    return a.unionByName(g)


TOP_USER = "(SELECT user_id FROM active ORDER BY shared_song_count DESC, user_id LIMIT 1)"


def _top_user(spark, d) -> str:
    """The most active listener of the popular songs: one id."""
    plays = star.triplets(spark, d)
    return ix.active_users(plays, ix.popular_songs(plays, 80), 1).first()["user_id"]


def _user_profile(spark, d):
    return content.user_profile(star.triplets(spark, d), star.tracks(spark, d), star.genres(spark, d),
                                user_id=_top_user(spark, d), min_plays=10)


@register("one_user_profile", ids="P12 F4 T8", sql=with_ctes(
    ["triplets", "tracks", "genres", "active"],
    f"SELECT * FROM prof WHERE user_id = {TOP_USER} ORDER BY play_count DESC, track_id, genre", CONTENT))
def one_user_profile(spark, d):
    return _user_profile(spark, d)


@register("one_user_content", ids="P13", sql=with_ctes(["triplets", "tracks", "genres", "active"], f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, track_id, genre) AS rank
        FROM csc WHERE user_id = {TOP_USER})
    WHERE rank <= {K}""", CONTENT))
def one_user_content(spark, d):
    catalogue = content.artist_genre(star.tracks(spark, d), star.genres(spark, d))
    return content.recommend(_user_profile(spark, d), catalogue, K)


@register("artist_genre_roundtrip", ids="S8 K4", sql=csql("SELECT * FROM ag"))
def artist_genre_roundtrip(spark, d):
    path = shared_path(spark, "artist-genre")
    content.save_artist_genre(content.artist_genre(star.tracks(spark, d), star.genres(spark, d)), path)
    return content.load_artist_genre(spark, path)


@register("song_vectors_roundtrip", ids="K3", sql=csql("""
    SELECT track_id, genre, 'artist=' || artist AS feature, round(1 / sqrt(2), 6) AS weight FROM ag
    UNION ALL
    SELECT track_id, genre, 'genre=' || genre AS feature, round(1 / sqrt(2), 6) AS weight FROM ag"""))
def song_vectors_roundtrip(spark, d):
    path = shared_path(spark, "song-vectors")
    rows = content.artist_genre(star.tracks(spark, d), star.genres(spark, d))
    content.save_song_vectors(content.song_vectors(rows), path)
    return content.load_song_vectors(spark, path).withColumn("weight", F.round("weight", 6))


@register("song_vectors_lookup", ids="K3 J6", sql=csql("""
    SELECT p.user_id, p.track_id, ag.genre, kind || CASE kind WHEN 'artist=' THEN ag.artist ELSE ag.genre END AS feature,
           round(1 / sqrt(2), 6) AS weight
    FROM prof p JOIN ag ON p.track_id = ag.track_id, (VALUES ('artist='), ('genre=')) AS f(kind)"""))
def song_vectors_lookup(spark, d):
    """The vectors of every user's tracks, from the table kept by ``track_id``."""
    rows = content.artist_genre(star.tracks(spark, d), star.genres(spark, d))
    kept = lookup.save_by_key(content.song_vectors(rows), shared_path(spark, "song-vectors-by-key"))
    return _profile(spark, d).select("user_id", "track_id").join(kept, "track_id").select(
        "user_id", "track_id", "genre", "feature", F.round("weight", 6).alias("weight"))
