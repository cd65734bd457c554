"""Named factor-model queries; checked on rows and invariants."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from listenlens.functions import dot
from listenlens.operators import evaluate, factors, ranking
from listenlens.operators import interactions as ix
from listenlens.plans.interactions import core_rows
from listenlens.plans.recommend import _cf
from listenlens.plans.registry import register
from listenlens.plans.sql import with_ctes
from listenlens.session import materialize
from listenlens.sources import star

SVD_RANK = 20


@register("svd_scores", ids="M2")
def svd_scores(spark, d):
    # the reconstruction at the core's own pairs, held-out ones included
    core, train, _ = _cf(spark, d)
    return factors.svd_scores(train, core, SVD_RANK).withColumn("score", F.round("score", 6))


@register("svd_invariants", ids="M2", sql=with_ctes(["train"], """
    SELECT CAST(range + 1 AS BIGINT) AS rank, true AS orthonormal, true AS descending, true AS energy_within,
           (SELECT round(CAST(sum(play_count * play_count) AS DOUBLE), 3) FROM train) AS energy
    FROM range(20)"""))
def svd_invariants(spark, d):
    # of the factors themselves: VᵀV = 1, UᵀU = S², values descending, and no more energy in
    # the first ranks than in the matrix
    _, train, _ = _cf(spark, d)
    users, items, values = factors.svd_vectors(train, SVD_RANK)
    inner = []
    for rows, key in ((items, "song_id"), (users, "user_id")):
        one, two = (rows.select(key, F.posexplode("v").alias(i, x)) for i, x in (("_i", "_x"), ("_j", "_y")))
        inner.append(one.join(two, key).groupBy("_i", "_j").agg(F.sum(F.col("_x") * F.col("_y")).alias("_p")))
    size = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "_i int, _s double")
    of_items, of_users = (p.withColumn("_p", F.when(F.col("_i") == F.col("_j"), F.col("_p") - w).otherwise(F.col("_p")))
                          .groupBy("_i").agg(F.max(F.abs("_p")).alias(n))
                          for p, w, n in ((inner[0], 1.0, "_v"), (inner[1].join(size, "_i"), F.col("_s") * F.col("_s"), "_u")))
    total = train.agg(F.sum(F.col("play_count").cast("double") * F.col("play_count")).alias("_t"))
    every = Window.orderBy("_i")  # over k rows
    rows = size.join(of_items, "_i").join(of_users, "_i").join(total)
    return rows.select(
        (F.col("_i") + 1).cast("long").alias("rank"),
        ((F.col("_v") < 1e-9) & (F.col("_u") < 1e-9 * values[0] ** 2)).alias("orthonormal"),
        (F.coalesce(F.lag("_s").over(every), F.col("_s")) >= F.col("_s")).alias("descending"),
        (F.sum(F.col("_s") * F.col("_s")).over(every) <= F.col("_t") * (1 + 1e-9)).alias("energy_within"),
        F.round("_t", 3).alias("energy"))


@register("svd_recommend", ids="M3 P9")
def svd_recommend(spark, d):
    core, train, _ = _cf(spark, d)
    return factors.svd_recommend(train, core, SVD_RANK, 10).withColumn("score", F.round("score", 6))


@register("svd_precision_at_10", ids="M3 A10")
def svd_precision_at_10(spark, d):
    core, train, test = _cf(spark, d)
    p = evaluate.precision_at_k(factors.svd_recommend(train, core, SVD_RANK, 10), test, 10)
    return p.withColumn("precision_at_k", F.round("precision_at_k", 6))


def _als_train(spark, d):
    parts = ix.random_split(ix.binarize(core_rows(spark, d)), 0.2, seed=42)
    return parts.where(F.col("split") == "train")


@register("als_candidates", ids="M5 P11")
def als_candidates(spark, d):
    # the lists restricted to candidates: the 40 most listened songs
    train = _als_train(spark, d)
    songs = ix.popular_songs(star.triplets(spark, d), 40)
    return factors.als_recommend(train.select("user_id", "song_id", "label"),
                                 train.select("user_id", "song_id", "play_count"), top=10, candidates=songs,
                                 rank=8, max_iter=10, seed=42).withColumn("score", F.round("score", 6))


@register("als_user_scores", ids="M5 X10")
def als_user_scores(spark, d):
    # one user (the most active) over given candidates: the most listened songs
    train, plays = _als_train(spark, d), star.triplets(spark, d)
    popular = ix.popular_songs(plays, 80)
    model, users, items = factors.als_fit(train.select("user_id", "song_id", "label"), rank=8, max_iter=10, seed=42)
    user = ix.active_users(plays, popular, 1).first()["user_id"]
    pairs = popular.select(F.lit(user).alias("user_id"), "song_id")
    return factors.als_scores(model, users, items, pairs).withColumn("score", F.round("score", 6))


@register("als_recommend", ids="M4 M5 P11 D3 D4 F9 X10")
def als_recommend(spark, d):
    train = _als_train(spark, d)
    return factors.als_recommend(train.select("user_id", "song_id", "label"),
                                 train.select("user_id", "song_id", "play_count"), top=10,
                                 rank=8, max_iter=10, seed=42).withColumn("score", F.round("score", 6))


RANKING = dict(rank=8, epochs=4, blocks=2, draws=2, batch=64)


def _ranking(spark, d):
    core = core_rows(spark, d)
    users, items = ranking.fit(core, **RANKING)
    return core, users, items


@register("ranking_recommend", ids="D5 M4 P11")
def ranking_recommend(spark, d):
    core, users, items = _ranking(spark, d)
    return ranking.recommend(users, items, core, 10).withColumn("score", F.round("score", 6))


@register("ranking_invariants", ids="D5 M4 P11", sql=with_ctes(["core"], """
    SELECT user_id, least(10, (SELECT count(DISTINCT song_id) FROM core) - count(*)) AS n_recs,
           least(10, (SELECT count(DISTINCT song_id) FROM core) - count(*)) AS last_rank,
           0::BIGINT AS n_heard, 0::BIGINT AS n_out_of_order, true AS learned
    FROM core WHERE play_count > 0 GROUP BY user_id
    HAVING count(*) < (SELECT count(DISTINCT song_id) FROM core)"""))
def ranking_invariants(spark, d):
    """Lists: length, ranks, no heard song, scores in order; and heard songs get more
    than freshly drawn unheard ones on average."""
    core, users, items = _ranking(spark, d)
    users, items = materialize(users), materialize(items)
    recs = materialize(ranking.recommend(users, items, core, 10))
    after = recs.select("user_id", (F.col("rank") + 1).alias("rank"), F.col("score").alias("before"))
    heard = core.where(F.col("play_count") > 0).select("user_id", "song_id", F.lit(1).alias("heard"))
    lists = (recs.join(after, ["user_id", "rank"], "left").join(heard, ["user_id", "song_id"], "left").groupBy("user_id")
             .agg(F.count("song_id").alias("n_recs"), F.max("rank").cast("long").alias("last_rank"), F.count("heard").alias("n_heard"),
                  F.sum(F.when(F.col("score") > F.col("before"), 1).otherwise(0)).alias("n_out_of_order")))
    pairs = ix.negative_samples(core, seed=7).join(users.withColumnRenamed("v", "p"), "user_id").join(
        items.withColumnRenamed("v", "q"), "song_id")
    score = F.when(F.col("label") > 0, 1.0).otherwise(-1.0) * dot(F.col("p"), F.col("q"))
    learned = pairs.agg(F.sum(score) > 0).first()[0]
    return lists.withColumn("learned", F.lit(bool(learned)))
