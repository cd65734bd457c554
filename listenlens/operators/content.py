"""Content-based recommendation from artist + genre vectors
(S8, A5, A14, A15, F5, J6, J7, M6, K3, K4, T8, P12, P13).

Song vector (M6): the L2-normalised one-hot code of (artist, genre), i.e.
weight 1/√2 on ``artist=<a>`` and on ``genre=<g>``.  The learned song encoder
of the workload is trained to reconstruct exactly that pair, so the one-hot
code is the lossless version of it.  Vectors are long rows
``(track_id, genre, feature, weight)``, never dense arrays.

Taste vector (A14/A15): the mean of the profile's song vectors, normalised.

Recommendation (P13): cosine of taste and song vectors, top-k per user, heard
songs not excluded.  A song's score depends only on its (artist, genre) pair:
``(T[artist] + T[genre]) / √2``.  So instead of scoring every song for every
user (a users × songs product), candidates are pulled exactly:

1. songs whose artist is in the profile: per (artist, genre) pair only its
   ``k`` smallest track ids can enter a top-k (equal scores, id tie-break),
   and only pairs whose better-scored predecessors hold fewer than ``k``
   songs are expanded;
2. songs of a profile genre by other artists: all score ``T[genre]/√2`` and
   are needed only if that reaches the user's k-th best score from step 1
   (exact pruning).  The ``k`` smallest such ids lie within the ``k`` first
   (artist, genre) pairs, by smallest id, whose artist is not the user's; these
   are among the genre's first ``k + (user's artists)`` pairs;
3. zero-score songs for users with fewer than ``k`` positive songs: among the
   catalogue's first ``2k`` songs.

The user's (artist, genre) pairs are as many as artists times genres, so they are
scored inside the row of the user's artist, against the genres packed beside the
artist, and only pairs that can matter become rows.  A pair of ``k`` songs alone
fills the user's list: the best such pair bounds the k-th score from below, and
pairs and genres that score less are left out (exact).

The three parts are always united (an empty part costs little).  Every
``row_number() <= n`` is planned with a map-side group limit, so a genre with a
third of the catalogue is cut down before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlens.session import materialize

U = "user_id"
INV_SQRT2 = 1.0 / math.sqrt(2.0)
#: (artist, genre) pairs of a catalogue whose tables are sent to every task; those of
#: larger catalogues are joined as Spark chooses.
MOST_SENT = 65_536
#: More than rounding to 6 digits can move two scores apart.
ROUNDED = 2e-6


def artists(tracks: DataFrame) -> DataFrame:
    """A5: distinct artists."""
    return tracks.select("artist").distinct()


def artist_genre(tracks: DataFrame, genres: DataFrame) -> DataFrame:
    """``(track_id, genre, artist)`` — the catalogue rows that get vectors."""
    return tracks.select("track_id", "artist").join(genres.select("track_id", "genre"), "track_id") \
        .select("track_id", "genre", "artist")


def save_artist_genre(rows: DataFrame, path: str) -> None:
    """K4."""
    rows.write.mode("overwrite").parquet(path)


def load_artist_genre(spark, path: str) -> DataFrame:
    """The rows saved by ``save_artist_genre``."""
    return spark.read.parquet(path).select("track_id", "genre", "artist")


def user_profile(plays: DataFrame, tracks: DataFrame, genres: DataFrame, user_id=None,
                 min_plays: int = 10) -> DataFrame:
    """Tracks a user played at least ``min_plays`` times, with
    genre: ``(user_id, track_id, artist, play_count, genre)``.  With a
    ``user_id`` the filter is pushed into the scan and rows are ordered by plays;
    without one, every user's profile (unordered)."""
    p = plays.where(F.col("play_count") >= min_plays)
    songs, styles = tracks.select("song_id", "track_id", "artist"), genres.select("track_id", "genre")
    columns = [U, "track_id", "artist", "play_count", "genre"]
    if user_id is not None:
        p = p.where(F.col(U) == F.lit(user_id))
        return (p.join(songs, "song_id").join(styles, "track_id").select(*columns)
                .orderBy(F.desc("play_count"), "track_id", "genre"))
    # the catalogue is joined first: the plays of all users are shuffled once
    return p.join(songs.join(styles, "track_id"), "song_id").select(*columns)


def _features(df: DataFrame) -> DataFrame:
    return df.select("*", F.explode(F.array(
        F.concat(F.lit("artist="), F.col("artist")),
        F.concat(F.lit("genre="), F.col("genre")))).alias("feature"))


def song_vectors(rows: DataFrame) -> DataFrame:
    """M6/K3: ``(track_id, genre, feature, weight)`` unit one-hot code."""
    return _features(rows).select("track_id", "genre", "feature", F.lit(INV_SQRT2).alias("weight"))


def taste_vector(profile: DataFrame) -> DataFrame:
    """A14 + A15: ``(user_id, feature, weight)`` — mean of the profile's song
    vectors, L2-normalised.  All weights of the one-hot vectors are equal, so that
    is the count of a feature over the norm of the user's counts."""
    # dealt by user once: features are counted and normalised where the user's rows lie
    mine = profile.where(F.col(U).isNotNull()).select(U, "artist", "genre").repartition(U)
    counts = _features(mine).groupBy(U, "feature").agg(F.count(F.lit(1)).alias("_c"))
    norm = F.sqrt(F.sum((F.col("_c") * F.col("_c")).cast("double")).over(Window.partitionBy(U)))
    return counts.select(U, "feature", (F.col("_c") / norm).alias("weight"))


def recommend(profile: DataFrame, catalogue: DataFrame, k: int = 10) -> DataFrame:
    """``(user_id, track_id, genre, artist, score, rank)``; score rounded to
    6 digits, ties by ``track_id`` then ``genre``; heard songs stay in.  An empty
    profile or catalogue gives no rows."""
    cat = materialize(catalogue.select("track_id", "genre", "artist").distinct())  # read several times
    combos = materialize(cat.groupBy("artist", "genre").agg(
        F.count(F.lit(1)).alias("n_ag"), F.min("track_id").alias("_first")))
    w_combo = Window.partitionBy("artist", "genre").orderBy("track_id")
    combo_head = materialize(cat.withColumn("_r", F.row_number().over(w_combo)).where(F.col("_r") <= k).drop("_r"))
    send = F.broadcast if combos.count() <= MOST_SENT else lambda df: df

    # the parts of the taste that can matter, with what bounds the user's k-th score: read several times
    taste = materialize(_bounded_taste(taste_vector(profile), combos, send, k))
    pairs = taste.where(F.col("artist").isNotNull()).select(
        U, "artist", F.col("weight").alias("wa"), F.inline("pairs"))
    ta = taste.where(F.col("artist").isNotNull() & F.col("_least").isNull()).select(U, "artist")
    tg = taste.where(F.col("genre").isNotNull()).select(U, "genre", F.col("weight").alias("wg"), "_least")
    users = taste.where(F.col("_least").isNull()).select(U).distinct()
    needed = _needed_pairs(pairs, k)
    c1 = needed.join(send(combo_head), ["artist", "genre"]).select(U, "track_id", "genre", "artist", "score")
    c2 = _of_own_genres(pairs, tg, combos, combo_head, needed, send, k)
    c3 = _fillers(pairs, users, ta, tg.where(F.col("_least").isNull()), combos, cat, k)
    cand = c1.unionByName(c2).unionByName(c3)
    # no part gives a song twice, but several artists of one track do
    if cat.groupBy("track_id", "genre").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(1).count():
        cand = cand.repartition(U).dropDuplicates([U, "track_id", "genre"])
    w = Window.partitionBy(U).orderBy(F.desc("score"), F.asc("track_id"), F.asc("genre"))
    return (cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("long"))
            .select(U, "track_id", "genre", "artist", "score", "rank"))


def _bounded_taste(taste: DataFrame, combos: DataFrame, send, k: int) -> DataFrame:
    """``(user_id, artist, genre, weight, pairs, _least)``: the taste's rows, of artists
    (with their ``pairs``: genre, the user's weight ``wg`` of it, ``n_ag``) and of genres.

    ``_least``: the best score of a pair of ``k`` songs or more of the user's heaviest
    artists with one, null if the user has none; the user's k-th score is not below it.  Pairs and genres that score less,
    and artists that keep no pair, are left out; without ``_least`` all rows stay."""
    w = Window.partitionBy(U)
    named = lambda kind: F.when(F.col("feature").startswith(f"{kind}="), F.col("feature").substr(F.lit(len(kind) + 2), F.length("feature")))
    rows = taste.select(U, named("artist").alias("artist"), named("genre").alias("genre"), "weight")
    packed = combos.where(F.col("artist").isNotNull()).groupBy(F.concat(F.lit("artist="), "artist").alias("_key")).agg(
        F.collect_list(F.struct("genre", "n_ag")).alias("_all"),
        F.max(F.when(F.col("genre").isNotNull() & (F.col("n_ag") >= k), True)).alias("_full"))
    # rows of no artist meet nothing: their keys are spread
    key = F.coalesce(F.concat(F.lit("artist="), "artist"), F.concat(F.lit("user="), U))
    rows = (rows.withColumn("_key", key).join(send(packed), "_key", "left").drop("_key")
            .withColumn("_styles", F.collect_list(F.when(F.col("genre").isNotNull(), F.struct("genre", "weight"))).over(w))
            .withColumn("_wg", F.coalesce(F.max(F.when(F.col("genre").isNotNull(), F.col("weight"))).over(w), F.lit(0.0)))
            .withColumn("_heaviest", F.max(F.when(F.col("_full"), F.col("weight"))).over(w)))
    # scored are the heaviest artists that have such a pair, then those that can reach their best one
    of = F.map_from_entries("_styles")
    wg = lambda x: F.when(x["genre"].isNotNull(), of[x["genre"]])
    weigh = lambda g: (F.col("weight") + F.coalesce(g, F.lit(0.0))) * INV_SQRT2
    best = F.array_max(F.transform(F.filter("_all", lambda x: x["genre"].isNotNull() & (x["n_ag"] >= k)), lambda x: weigh(wg(x))))
    rows = rows.withColumn("_least", F.max(F.when(F.col("_full") & (F.col("weight") == F.col("_heaviest")), best)).over(w) - ROUNDED)
    free = F.col("_least").isNull()
    rows = rows.where(free | ((F.col("weight") + F.when(F.col("artist").isNotNull(), F.col("_wg")).otherwise(0.0)) * INV_SQRT2 >= F.col("_least")))
    pairs = F.transform("_all", lambda x: F.struct(x["genre"].alias("genre"), wg(x).alias("wg"), x["n_ag"].alias("n_ag")))
    kept = F.filter(pairs, lambda x: free | (weigh(x["wg"]) >= F.col("_least")) | F.coalesce(x["wg"] * INV_SQRT2 >= F.col("_least"), F.lit(False)))
    return (rows.select(U, "artist", "genre", "weight", kept.alias("pairs"), "_least")
            .where(F.col("_least").isNull() | F.col("genre").isNotNull() | (F.size("pairs") > 0)))


def _needed_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """Step 1, ``(user_id, artist, genre, score, _m, _better)``.  A pair contributes at
    most k songs (``_m``), all with the pair's score, so only the pairs whose better
    ones hold fewer than k songs (plus ties) are expanded to songs."""
    pairs = pairs.select(U, "artist", "genre",
                         F.round((F.col("wa") + F.coalesce(F.col("wg"), F.lit(0.0))) * INV_SQRT2, 6).alias("score"),
                         F.least(F.col("n_ag"), F.lit(k)).alias("_m"))
    # songs of strictly better pairs: a range frame over the score in units of
    # 1e-6 (scores are rounded to 6 digits), ending one unit above the row
    w_better = (Window.partitionBy(U).orderBy(F.desc("_iscore"))
                .rangeBetween(Window.unboundedPreceding, -1))
    return (pairs.withColumn("_iscore", F.round(F.col("score") * 1e6).cast("long"))
            .withColumn("_better", F.coalesce(F.sum("_m").over(w_better), F.lit(0)))
            .where(F.col("_better") < k))


def _of_own_genres(pairs: DataFrame, tg: DataFrame, combos: DataFrame, combo_head: DataFrame, needed: DataFrame, send, k: int) -> DataFrame:
    """Step 2, for the (user, genre) pairs that can reach the user's k-th score."""
    # the k-th song of step 1 is of the first pair, by score, that fills the list
    w_upto = (Window.partitionBy(U).orderBy(F.desc("_iscore"))
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    kth = (needed.where(F.col("genre").isNotNull()).withColumn("_upto", F.sum("_m").over(w_upto))
           .where(F.col("_upto") >= k).groupBy(U).agg(F.max("score").alias("_kth")))
    # how many of the genre's pairs are the user's own artists
    n_artists = pairs.groupBy(U, "genre").agg(F.count(F.lit(1)).alias("_own"))
    most = n_artists.agg(F.max("_own")).first()[0] or 0  # a scalar: how many pairs of a genre are ranked
    w_genre = Window.partitionBy("genre").orderBy("_first", "artist")
    ranked = (combos.withColumn("_at", F.row_number().over(w_genre)).where(F.col("_at") <= k + most)
              .select("genre", "artist", "_first", "_at"))
    asks = (tg.drop("_least").join(kth, U, "left").withColumn("score", F.round(F.col("wg") * INV_SQRT2, 6))
            .where(F.col("_kth").isNull() | (F.col("score") >= F.col("_kth")))
            .join(n_artists, [U, "genre"], "left").withColumn("_own", F.coalesce("_own", F.lit(0)))
            .select(U, "genre", "score", F.explode(F.sequence(F.lit(1), (F.col("_own") + k).cast("int"))).alias("_at")))
    # all pairs of an asked genre's own artists are kept
    others = asks.join(send(ranked), ["genre", "_at"]).join(pairs.select(U, "genre", "artist"), [U, "genre", "artist"], "left_anti")
    w_first = Window.partitionBy(U, "genre").orderBy("_first", "artist")
    chosen = others.withColumn("_r", F.row_number().over(w_first)).where(F.col("_r") <= k)
    songs = chosen.select(U, "genre", "artist", "score").join(send(combo_head), ["artist", "genre"])
    w_song = Window.partitionBy(U, "genre").orderBy("track_id")
    return (songs.withColumn("_r", F.row_number().over(w_song)).where(F.col("_r") <= k)
            .select(U, "track_id", "genre", "artist", "score"))


def _fillers(pairs: DataFrame, users: DataFrame, ta: DataFrame, tg: DataFrame, combos: DataFrame, cat: DataFrame, k: int) -> DataFrame:
    """Step 3: the first songs that share neither artist nor genre, for users with
    fewer than k songs that share one; ``users``: those without a pair of k songs."""
    genre_n = combos.groupBy("genre").agg(F.sum("n_ag").alias("n_g"))
    # songs of the user's artists outside the user's genres, and of those genres
    n_artist = pairs.where(F.col("wg").isNull()).groupBy(U).agg(F.sum("n_ag").alias("_na"))
    n_genre = tg.join(genre_n, "genre").groupBy(U).agg(F.sum("n_g").alias("_ng"))
    n_pos = (users.join(n_artist, U, "left").join(n_genre, U, "left")
             .select(U, (F.coalesce("_na", F.lit(0)) + F.coalesce("_ng", F.lit(0))).alias("_npos")))
    short = n_pos.where(F.col("_npos") < k)
    # at most 2k rows, numbered in one small task
    head = cat.orderBy("track_id", "genre", "artist").limit(2 * k).withColumn(
        "_tp", F.row_number().over(Window.orderBy("track_id", "genre", "artist")) - 1)
    return (short.select(U, F.explode(F.sequence(F.lit(0), (F.col("_npos") + F.lit(k - 1)).cast("int"))).alias("_tp"))
            .join(head, "_tp")
            .join(ta.select(U, "artist"), [U, "artist"], "left_anti")
            .join(tg.select(U, "genre"), [U, "genre"], "left_anti")
            .select(U, "track_id", "genre", "artist", F.lit(0.0).alias("score")))


def save_song_vectors(vectors: DataFrame, path: str) -> None:
    """K3: persist song vectors keyed by ``track_id`` (not by row order)."""
    vectors.write.mode("overwrite").partitionBy("genre").parquet(path)


def load_song_vectors(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).select("track_id", "genre", "feature", "weight")
