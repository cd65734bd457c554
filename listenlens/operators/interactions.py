"""User-item interactions: dense core, pivots, splits, encodings, samples
(F8-F10, J4, J5, A2, A3, A7, T4, D1, D3-D7).

Everything stays a long ``(user_id, song_id, value)`` DataFrame.  "Random"
choices are seeded md5 draws, so a recomputed partition (lost executor)
yields the same rows as the first attempt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlens.functions.columns import holdout_size, md5_fraction, md5_order
from listenlens.functions.indexing import dense_index, label_codes
from listenlens.functions.ranking import rank_within
from listenlens.session import materialize

U, S, P = "user_id", "song_id", "play_count"


def popular_songs(plays: DataFrame, songs_limit: int = 80) -> DataFrame:
    """A2/T4: ``(song_id, shared_users_count)``, the ``songs_limit`` songs with most
    listener rows (``count(user_id)``, not distinct), ties by ``song_id``."""
    return (plays.groupBy(S).agg(F.count(U).alias("shared_users_count"))
            .orderBy(F.desc("shared_users_count"), F.asc(S)).limit(songs_limit))


def active_users(plays: DataFrame, popular: DataFrame, users_limit: int = 50) -> DataFrame:
    """``(user_id, shared_song_count)`` over the popular songs."""
    return (plays.join(popular.select(S), S, "left_semi").groupBy(U)
            .agg(F.count(S).alias("shared_song_count"))
            .orderBy(F.desc("shared_song_count"), F.asc(U)).limit(users_limit))


def core(plays: DataFrame, songs_limit: int = 80, users_limit: int = 50) -> DataFrame:
    """Plays of the most active users on the most listened songs.

    ``popular`` is computed once and written (the workload inlined it twice
    without a tie-break); so is the user list.  Both hold at most their limit of
    ids, so their written size lets Spark pick a broadcast semi-join.
    """
    popular = materialize(popular_songs(plays, songs_limit))
    users = materialize(active_users(plays, popular, users_limit))
    return (plays.join(users.select(U), U, "left_semi")
            .join(popular.select(S), S, "left_semi")
            .select(U, S, P))


def user_item_matrix(rows: DataFrame) -> DataFrame:
    """A7 (long form): one value per (user, song), the mean of duplicates."""
    return rows.groupBy(U, S).agg(F.avg(P).alias(P))


def pivot(rows: DataFrame, songs: list[str]) -> DataFrame:
    """A7 (wide form, on request): user × song matrix, mean, 0 where missing.

    The caller names the columns; a core has at most ``songs_limit`` of them."""
    return rows.groupBy(U).pivot(S, songs).agg(F.avg(P)).na.fill(0.0)


def positive(rows: DataFrame) -> DataFrame:
    """F8: drop non-positive interactions."""
    return rows.where(F.col(P) > 0)


def binarize(rows: DataFrame, col: str = P, out: str = "label") -> DataFrame:
    """``(col > 0)`` as a 0/1 float."""
    return rows.withColumn(out, (F.col(col) > 0).cast("float"))


def explicit_samples(rows: DataFrame) -> DataFrame:
    """``(user_id, song_id, label=float(play_count))`` for positive rows."""
    return positive(rows).select(U, S, F.col(P).cast("float").alias("label"))


def index_ids(rows: DataFrame) -> DataFrame:
    """0-based label codes of users and songs by sorted id (distributed)."""
    users = label_codes(rows, U, "user_index")
    songs = label_codes(rows, S, "item_index")
    return rows.join(users, U).join(songs, S)


def holdout_split(rows: DataFrame, test_size: float = 0.2, min_items: int = 5,
                  seed: int = 42) -> DataFrame:
    """Per user with at least ``min_items`` positive items, move
    ``max(1, int(n * test_size))`` of them (seeded md5 order) to ``test``.

    Adds ``split``.  Ranks come from ``rank_within``, so a user with a large share
    of the rows is spread over all tasks.
    """
    keyed = positive(rows).withColumn("_h", md5_order(U, S, seed=seed))
    n = keyed.groupBy(U).agg(F.count(F.lit(1)).alias("_n"))
    ranked = rank_within(keyed, U, ["_h", S], name="_rn").join(n, U)
    is_test = (F.col("_n") >= min_items) & (F.col("_rn") <= holdout_size(F.col("_n"), test_size))
    return ranked.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("_n", "_rn", "_h")


def random_split(rows: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """D3: per-row seeded draw; ``test`` when the md5 fraction is below the cut.
    No global sort, no shuffle."""
    return rows.withColumn(
        "split", F.when(md5_fraction(U, S, seed=seed) < test_fraction, "test").otherwise("train"))


def negative_samples(rows: DataFrame, items: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """For each positive (u, i) emit (u, i, 1.0) and (u, j, 0.0), j a seeded
    uniform draw among the songs u has not heard.

    Exact, without retry caps: the draw ``r = floor(f * n_unseen)`` is mapped to
    the r-th unheard song index.  With u's heard indices sorted as
    ``s_0 < s_1 < ...``, the gaps ``s_p - p`` are non-decreasing and the r-th
    unheard index is ``r + #{p : s_p - p <= r}``.  That count is the draw's rank
    among u's gaps and draws together, less its rank among the draws; ranks come
    from ``rank_within``, so no user is one task.  A user who heard every song gets
    no negative row.  ``items`` is the song universe (default: songs of ``rows``).
    """
    pos = positive(rows).select(U, S)
    universe = (items if items is not None else pos).select(S).distinct()
    idx = dense_index(universe, [S], name="_ii")
    m = idx.count()  # a scalar job; nothing but the number reaches the driver
    heard = pos.join(idx, S)
    n = pos.groupBy(U).agg(F.count(F.lit(1)).alias("_n"))
    gaps = rank_within(heard, U, ["_ii"], name="_p").select(
        U, (F.col("_ii") - F.col("_p") + 1).alias("_key"), F.lit(0).alias("_kind"), F.col("_ii").alias("_tie"),
        F.lit(0).cast("long").alias("_d"))
    draws = (heard.join(n, U).withColumn("_unseen", F.lit(m) - F.col("_n"))
             .where(F.col("_unseen") > 0)
             .select(U, F.floor(md5_fraction(U, S, F.lit("neg"), seed=seed) * F.col("_unseen"))
                     .alias("_key"), F.lit(1).alias("_kind"), F.col("_ii").alias("_tie")))
    draws = rank_within(draws, U, ["_key", "_tie"], name="_d")
    placed = (rank_within(gaps.unionByName(draws), U, ["_key", "_kind", "_tie"], name="_r")
              .where(F.col("_kind") == 1)
              .select(U, (F.col("_key") + F.col("_r") - F.col("_d")).alias("_ii")))
    negatives = placed.join(idx, "_ii").select(U, S, F.lit(0.0).cast("float").alias("label"))
    positives = pos.select(U, S, F.lit(1.0).cast("float").alias("label"))
    return positives.unionByName(negatives)
