"""Named item-cosine recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from listenlens.operators import evaluate, neighbours, recommend, similarity
from listenlens.operators import interactions as ix
from listenlens.plans.interactions import core_rows, split_rows
from listenlens.plans.registry import register
from listenlens.plans.sql import with_ctes
from listenlens.sources import star

K = 10

SIM = """
    SELECT a.song_id AS item_i, b.song_id AS item_j,
           sum(CAST(a.play_count AS DOUBLE) * b.play_count) / (ni.n * nj.n) AS sim
    FROM train a JOIN train b ON a.user_id = b.user_id
    JOIN norms ni ON ni.song_id = a.song_id JOIN norms nj ON nj.song_id = b.song_id
    GROUP BY a.song_id, b.song_id, ni.n, nj.n"""
NORMS = "SELECT song_id, sqrt(sum(CAST(play_count AS DOUBLE) * play_count)) AS n FROM train GROUP BY song_id"
REACHED = """
    SELECT t.user_id, m.item_j AS song_id, sum(m.sim * t.play_count) AS score
    FROM train t JOIN sim m ON t.song_id = m.item_i GROUP BY t.user_id, m.item_j"""
SCORES = """
    SELECT u.user_id, i.song_id, coalesce(s.score, 0.0) AS score
    FROM (SELECT DISTINCT user_id FROM train) u
    CROSS JOIN (SELECT DISTINCT song_id FROM core) i
    LEFT JOIN reached s ON s.user_id = u.user_id AND s.song_id = i.song_id"""
UNSEEN = """
    SELECT * FROM scores s WHERE NOT EXISTS (
        SELECT 1 FROM train t WHERE t.user_id = s.user_id AND t.song_id = s.song_id)"""
RECS = f"""
    SELECT * FROM (
        SELECT user_id, song_id, score,
               row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, song_id) AS rank
        FROM unseen) WHERE rank <= {K}"""
CF = {"norms": NORMS, "sim": SIM, "reached": REACHED, "scores": SCORES, "unseen": UNSEEN, "recs": RECS}


def cf_sql(body: str) -> str:
    return with_ctes(["core", "train", "test", "active", "tracks"], body, extra=CF)


def _cf(spark, d):
    core = core_rows(spark, d)
    split = split_rows(spark, d, core)
    train = split.where(F.col("split") == "train").select("user_id", "song_id", "play_count")
    test = split.where(F.col("split") == "test").select("user_id", "song_id", "play_count")
    return core, train, test


def _recs(spark, d):
    core, train, test = _cf(spark, d)
    sim = similarity.item_cosine(train)
    return recommend.recommend_all(train, sim, items=core, k=K), test


def _rounded(df, col="score"):
    return df.withColumn(col, F.round(col, 6))


@register("item_cosine", ids="A8 J13 X12", sql=cf_sql(
    "SELECT item_i, item_j, round(sim, 6) AS sim FROM sim"))
def item_cosine(spark, d):
    _, train, _ = _cf(spark, d)
    return _rounded(similarity.item_cosine(train), "sim")


@register("item_neighbours", ids="A8 J13 T6", sql=with_ctes(["triplets"], f"""
    SELECT item_i, item_j, sim, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY item_i ORDER BY sim DESC, item_j) AS rank FROM (
            SELECT a.song_id AS item_i, b.song_id AS item_j,
                   round(sum(CAST(a.play_count AS DOUBLE) * b.play_count) / (ni.n * nj.n), 6) AS sim
            FROM triplets a JOIN triplets b ON a.user_id = b.user_id AND a.song_id <> b.song_id
            JOIN catalogue_norms ni ON ni.song_id = a.song_id JOIN catalogue_norms nj ON nj.song_id = b.song_id
            GROUP BY a.song_id, b.song_id, ni.n, nj.n))
    WHERE rank <= {K}""", {"catalogue_norms": NORMS.replace("FROM train", "FROM triplets")}))
def item_neighbours(spark, d):
    # every song of every play, not the core
    return neighbours.item_neighbours(star.triplets(spark, d), k=K)


@register("item_scores", ids="A9 X11", sql=cf_sql(
    "SELECT user_id, song_id, round(score, 6) AS score FROM reached"))
def item_scores(spark, d):
    # the non-zero scores; an item that no neighbour reaches scores 0
    _, train, _ = _cf(spark, d)
    return _rounded(recommend.item_scores(train, similarity.item_cosine(train)))


@register("unseen_items", ids="J8 U3", sql=cf_sql(
    """SELECT user_id, song_id, round(score, 6) AS score FROM reached s WHERE NOT EXISTS (
        SELECT 1 FROM train t WHERE t.user_id = s.user_id AND t.song_id = s.song_id)"""))
def unseen_items(spark, d):
    _, train, _ = _cf(spark, d)
    scores = recommend.item_scores(train, similarity.item_cosine(train))
    return _rounded(recommend.unseen(scores, train))


@register("recommend_all", ids="T6 P8", sql=cf_sql(
    "SELECT user_id, song_id, round(score, 6) AS score, rank FROM recs"))
def recommend_all(spark, d):
    recs, _ = _recs(spark, d)
    return _rounded(recs)


@register("recommend_user", ids="T5", sql=cf_sql("""
    SELECT user_id, song_id, round(score, 6) AS score, rank FROM recs
    WHERE user_id = (SELECT user_id FROM active ORDER BY shared_song_count DESC, user_id LIMIT 1)"""))
def recommend_user(spark, d):
    core, train, _ = _cf(spark, d)
    plays = star.triplets(spark, d)
    # the user is data-derived: the most active listener of the core
    top_user = ix.active_users(plays, ix.popular_songs(plays, 80), 1).select("user_id")
    return _rounded(recommend.recommend_user(train, similarity.item_cosine(train), top_user, items=core, k=K))


@register("recommend_titles", ids="J12 P10 F2", sql=cf_sql("""
    SELECT DISTINCT r.user_id, r.rank, r.song_id, t.artist, t.title
    FROM recs r JOIN tracks t ON r.song_id = t.song_id"""))
def recommend_titles(spark, d):
    recs, _ = _recs(spark, d)
    return recommend.with_titles(recs, star.tracks(spark, d))


@register("precision_at_10", ids="A10 J9 U2", sql=cf_sql("""
    SELECT round(avg(coalesce(h.hits, 0) / 10.0), 6) AS precision_at_k
    FROM (SELECT DISTINCT user_id FROM test) u
    LEFT JOIN (SELECT r.user_id, count(*) AS hits FROM recs r
               JOIN test t ON r.user_id = t.user_id AND r.song_id = t.song_id GROUP BY r.user_id) h
      ON u.user_id = h.user_id"""))
def precision_at_10(spark, d):
    recs, test = _recs(spark, d)
    return _rounded(evaluate.precision_at_k(recs, test, k=K), "precision_at_k")
