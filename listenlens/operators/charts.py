"""Play-count charts.

Plans are aggregated before they are joined: plays are summed per song first
(map-side combined), then fanned out to every track of the song.  That is the
same sum as joining first, but the join and the track-level shuffle see one
row per song instead of one per play, which also defuses hot songs.
Every top-k has a total order: plays descending, then ``track_id``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlens.operators.skew import split_join

CHART_COLUMNS = ("artist", "title", "play_count")


def restrict_songs(tracks: DataFrame, song_ids=None) -> DataFrame:
    """keep tracks of the given songs; ``None`` or an empty list means no filter.

    A DataFrame of ids becomes a left-semi join (broadcast only when Spark's
    size check allows it); a short Python list becomes ``IN``.
    """
    if song_ids is None:
        return tracks
    if isinstance(song_ids, DataFrame):
        return tracks.join(song_ids.select("song_id").distinct(), "song_id", "left_semi")
    ids = [str(s) for s in song_ids]
    return tracks.where(F.col("song_id").isin(ids)) if ids else tracks


def plays_with_tracks(plays: DataFrame, tracks: DataFrame, cols: Iterable[str] | None = None,
                      song_ids=None, split: bool = False) -> DataFrame:
    """Plays ⋈ tracks on ``song_id`` (a song with several tracks fans out).
    ``split``: plays of very popular songs are dealt over several tasks."""
    wanted = restrict_songs(tracks, song_ids)
    joined = split_join(plays, wanted, "song_id") if split else plays.join(wanted, "song_id")
    return joined.select(*cols) if cols else joined


def track_totals(plays: DataFrame, tracks: DataFrame, song_ids=None, track_ids: DataFrame | None = None) -> DataFrame:
    """A1: ``(track_id, title, artist, play_count)`` summed over plays ⋈ tracks.

    ``track_ids``: a ``track_id`` table; only these tracks are totalled, and plays
    of other songs are dropped before they are summed."""
    if track_ids is not None:
        tracks = tracks.join(track_ids.select("track_id").distinct(), "track_id", "left_semi")
        plays = plays.join(tracks.select("song_id").distinct(), "song_id", "left_semi")
    per_song = plays.groupBy("song_id").agg(F.sum("play_count").alias("_song_plays"))
    return (per_song.join(restrict_songs(tracks, song_ids), "song_id")
            .groupBy("track_id", "title", "artist")
            .agg(F.sum("_song_plays").alias("play_count")))


def _ranked(df: DataFrame) -> list:
    return [F.desc("play_count"), F.asc("track_id")]


def top_tracks(plays: DataFrame, tracks: DataFrame, n: int = 250) -> DataFrame:
    """Global chart (TakeOrderedAndProject: per-task top-n, then merge)."""
    totals = track_totals(plays, tracks)
    return totals.orderBy(*_ranked(totals)).limit(n).select(*CHART_COLUMNS)


def genre_list(genres: DataFrame) -> DataFrame:
    """Distinct genres."""
    return genres.select("genre").distinct()


def top_by_genre(plays: DataFrame, tracks: DataFrame, genres: DataFrame, pattern: str,
                 n: int = 100) -> DataFrame:
    """Chart of the tracks whose genre is ``LIKE pattern``."""
    chosen = genres.where(F.col("genre").like(pattern)).select("track_id")
    hits = track_totals(plays, tracks, track_ids=chosen).join(chosen, "track_id")
    return hits.orderBy(*_ranked(hits)).limit(n).select(*CHART_COLUMNS)


def top_by_each_genre(plays: DataFrame, tracks: DataFrame, genres: DataFrame,
                      n: int = 100) -> DataFrame:
    """P3 for every genre at once: ``row_number() <= n`` per genre.

    Spark plans this with WindowGroupLimit before the shuffle, so even a genre
    holding a third of all tracks only ships its local top-n per task.
    """
    totals = track_totals(plays, tracks).join(genres, "track_id")
    w = Window.partitionBy("genre").orderBy(F.desc("play_count"), F.asc("track_id"))
    return (totals.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .withColumn("rank", F.col("rank").cast("long"))
            .select("genre", "rank", *CHART_COLUMNS))
