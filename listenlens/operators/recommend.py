"""Item-based recommendation.

Scores are ``score[u, j] = Σ_i sim[i, j] · plays[u, i]`` over the user's
training row.  ``item_scores`` lists the non-zero ones.  A top-k ranks every
item of the universe (an item no neighbour reaches scores 0 and can still fill
a list), but only its ``k`` rows per user leave a task: heard items are dropped
and the best kept inside the block product.  Ranking is score (rounded to 6
digits) desc, then item id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlens.operators import blockmat
from listenlens.operators.charts import restrict_songs

U, S, P = "user_id", "song_id", "play_count"


def item_scores(train: DataFrame, sim: DataFrame, block_size: int = blockmat.DEFAULT_BLOCK) -> DataFrame:
    """``(user_id, song_id, score)`` of every item that a neighbour reaches;
    all other items score 0."""
    rows = train.where(F.col(P) != 0)
    return blockmat.multiply(rows, sim, lr=U, lk=S, lv=P, rk="item_i", rc="item_j", rv="sim",
                             out_row=U, out_col=S, out_val="score", block_size=block_size)


def unseen(scores: DataFrame, train: DataFrame) -> DataFrame:
    """Drop items the user already heard in training."""
    return scores.join(train.where(F.col(P) > 0).select(U, S), [U, S], "left_anti")


def recommend_all(train: DataFrame, sim: DataFrame, items: DataFrame | None = None,
                  k: int = 10) -> DataFrame:
    """Top-k unseen items of every user of ``train``; ``items`` is the item
    universe (default: the items of ``train``)."""
    rows = train.where(F.col(P) != 0)
    universe = (items if items is not None else train).select(S)
    return blockmat.top_k_product(rows, sim, universe, train.where(F.col(P) > 0).select(U, S), k, lr=U, lk=S, lv=P,
                                  rk="item_i", rc="item_j", rv="sim", out_row=U, out_col=S)


def recommend_user(train: DataFrame, sim: DataFrame, user: DataFrame, items: DataFrame | None = None,
                   k: int = 10) -> DataFrame:
    """T5: the list of the users in ``user`` (a ``user_id`` table); only their
    rows are scored.  An unknown user gives an empty result."""
    own = train.join(user.select(U).distinct(), U, "left_semi")
    return recommend_all(own, sim, items if items is not None else train, k)


def with_titles(recs: DataFrame, tracks: DataFrame) -> DataFrame:
    """Artist and title of the recommended songs, one row per track,
    in rank order (``rank`` kept); an empty list gives nothing."""
    t = restrict_songs(tracks, recs.select(S)).select(S, "artist", "title")
    return recs.join(t, S).select(U, "rank", S, "artist", "title").distinct()
