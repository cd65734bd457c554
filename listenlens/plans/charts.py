"""Named chart queries."""

from __future__ import annotations

from listenlens.operators import charts, interactions
from listenlens.plans.registry import register
from listenlens.plans.sql import with_ctes
from listenlens.session import materialize
from listenlens.sources import parse_genre_lines, parse_track_lines, parse_triplet_lines, star


@register("top_tracks", ids="P1 J1 A1 T1", sql=with_ctes(["track_totals"], """
    SELECT artist, title, play_count FROM track_totals
    ORDER BY play_count DESC, track_id LIMIT 250"""))
def top_tracks(spark, d):
    return charts.top_tracks(star.triplets(spark, d), star.tracks(spark, d), n=250)


@register("track_lines_parse", ids="S2 S3 X1 X2 X3", sql=with_ctes(["tracks"], """
    SELECT track_id, song_id, artist, title FROM tracks"""))
def track_lines_parse(spark, d):
    return parse_track_lines(star.track_lines(spark, d))


@register("plays_with_tracks", ids="F1 J1", sql=with_ctes(["triplets", "tracks"], """
    SELECT t.track_id, t.artist, t.title, p.play_count
    FROM triplets p JOIN tracks t ON p.song_id = t.song_id"""))
def plays_with_tracks(spark, d):
    return charts.plays_with_tracks(star.triplets(spark, d), star.tracks(spark, d),
                                    cols=["track_id", "artist", "title", "play_count"])


@register("plays_with_tracks_split", ids="F1 J1", sql=with_ctes(["triplets", "tracks"], """
    SELECT t.track_id, t.artist, t.title, p.play_count
    FROM triplets p JOIN tracks t ON p.song_id = t.song_id"""))
def plays_with_tracks_split(spark, d):
    plays = materialize(star.triplets(spark, d))  # read by the pass that names hot songs and by the join
    return charts.plays_with_tracks(plays, star.tracks(spark, d), cols=["track_id", "artist", "title", "play_count"],
                                    split=True)


@register("track_totals", ids="A1", sql=with_ctes(["track_totals"], """
    SELECT track_id, title, artist, play_count FROM track_totals"""))
def track_totals(spark, d):
    return charts.track_totals(star.triplets(spark, d), star.tracks(spark, d))


@register("genres", ids="A4 P2", sql=with_ctes(["genres"], "SELECT DISTINCT genre FROM genres"))
def genres(spark, d):
    return charts.genre_list(star.genres(spark, d))


@register("top_by_genre", ids="P3 F3 J2 T2 X4", sql=with_ctes(["track_totals", "genres"], """
    SELECT tt.artist, tt.title, tt.play_count
    FROM track_totals tt JOIN genres g ON tt.track_id = g.track_id
    WHERE g.genre LIKE '%O%'
    ORDER BY tt.play_count DESC, tt.track_id LIMIT 100"""))
def top_by_genre(spark, d):
    return charts.top_by_genre(star.triplets(spark, d), star.tracks(spark, d),
                               star.genres(spark, d), pattern="%O%", n=100)


@register("top_by_each_genre", ids="P3 T2", sql=with_ctes(["track_totals", "genres"], """
    SELECT genre, rank, artist, title, play_count FROM (
        SELECT g.genre, tt.artist, tt.title, tt.play_count,
               row_number() OVER (PARTITION BY g.genre
                                  ORDER BY tt.play_count DESC, tt.track_id) AS rank
        FROM track_totals tt JOIN genres g ON tt.track_id = g.track_id)
    WHERE rank <= 100"""))
def top_by_each_genre(spark, d):
    return charts.top_by_each_genre(star.triplets(spark, d), star.tracks(spark, d),
                                    star.genres(spark, d), n=100)


@register("plays_for_song_list", ids="F2 J5", sql=with_ctes(["triplets", "tracks", "popular"], """
    SELECT t.artist, t.title, p.play_count
    FROM triplets p JOIN (SELECT * FROM tracks WHERE song_id IN (SELECT song_id FROM popular)) t
      ON p.song_id = t.song_id"""))
def plays_for_song_list(spark, d):
    # the id list is data-derived: the most-listened songs of the whole table
    popular = interactions.popular_songs(star.triplets(spark, d), songs_limit=80)
    return charts.plays_with_tracks(star.triplets(spark, d), star.tracks(spark, d),
                                    cols=["artist", "title", "play_count"], song_ids=popular)





@register("triplet_lines_parse", ids="S1 X6", sql=with_ctes(["triplets"], """
    SELECT user_id, song_id, CAST(play_count AS INTEGER) AS play_count FROM triplets"""))
def triplet_lines_parse(spark, d):
    return parse_triplet_lines(star.triplet_lines(spark, d))


@register("genre_lines_parse", ids="S4 X7", sql=with_ctes(["genres"], "SELECT track_id, genre FROM genres"))
def genre_lines_parse(spark, d):
    return parse_genre_lines(star.genre_lines(spark, d))


@register("top_by_each_genre_fanout", ids="J1 J2 P3", sql=with_ctes(["triplets", "tracks"], """
    SELECT genre, rank, artist, title, play_count FROM (
        SELECT s.genre, t.artist, t.title, t.play_count,
               row_number() OVER (PARTITION BY s.genre ORDER BY t.play_count DESC, t.track_id) AS rank
        FROM (SELECT r.track_id, r.title, r.artist, CAST(sum(p.play_count) AS BIGINT) AS play_count
              FROM triplets p JOIN releases r ON p.song_id = r.song_id
              GROUP BY r.track_id, r.title, r.artist) t
        JOIN styles s ON t.track_id = s.track_id)
    WHERE rank <= 100""", {
    "releases": """
        SELECT track_id, song_id, artist, title FROM tracks
        UNION ALL
        SELECT 'R' || p_partkey, CAST(p_partkey AS VARCHAR), p_brand, p_name || ' (again)' FROM part WHERE p_size > 25""",
    "styles": """
        SELECT r.track_id, unnest(CASE WHEN p.p_size % 3 = 0 THEN [p.p_type, p.p_brand] ELSE [p.p_type] END) AS genre
        FROM releases r JOIN part p ON r.song_id = CAST(p.p_partkey AS VARCHAR)"""}))
def top_by_each_genre_fanout(spark, d):
    """Songs with two tracks and tracks with two genres count in each of them."""
    return charts.top_by_each_genre(star.triplets(spark, d), star.releases(spark, d), star.styles(spark, d), n=100)
