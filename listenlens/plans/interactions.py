"""Named interaction queries over the dense core."""

from __future__ import annotations

from pyspark.sql import functions as F

from listenlens.operators import encoders
from listenlens.operators import interactions as ix
from listenlens.plans.registry import register
from listenlens.plans.sql import with_ctes
from listenlens.session import materialize, shared_path
from listenlens.sources import checked, star

FRACTION_SQL = "('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967296.0"


def core_rows(spark, d):
    # the core is bounded by songs_limit × users_limit rows and feeds many jobs
    return materialize(ix.core(star.triplets(spark, d), songs_limit=80, users_limit=50))


def split_rows(spark, d, core=None):
    core = core if core is not None else core_rows(spark, d)
    return ix.holdout_split(core, test_size=0.2, min_items=5, seed=42)


@register("popular_songs", ids="A2 T4", sql=with_ctes(["popular"], "SELECT * FROM popular"))
def popular_songs(spark, d):
    return ix.popular_songs(star.triplets(spark, d), 80)


@register("active_users", ids="A3 J5 T4", sql=with_ctes(["active"], "SELECT * FROM active"))
def active_users(spark, d):
    plays = star.triplets(spark, d)
    return ix.active_users(plays, ix.popular_songs(plays, 80), 50)


@register("interaction_core", ids="D7 J4 J5", sql=with_ctes(["core"], "SELECT * FROM core"))
def interaction_core(spark, d):
    return core_rows(spark, d)


@register("user_item_matrix", ids="A7", sql=with_ctes(["core"], """
    SELECT user_id, song_id, avg(play_count) AS play_count FROM core GROUP BY user_id, song_id"""))
def user_item_matrix(spark, d):
    return ix.user_item_matrix(core_rows(spark, d))


@register("user_item_pivot", ids="A7", sql=with_ctes(["core"], """
    SELECT u.user_id, s.song_id, coalesce(avg(c.play_count), 0) AS play_count
    FROM (SELECT DISTINCT user_id FROM core) u CROSS JOIN (SELECT DISTINCT song_id FROM core) s
    LEFT JOIN core c ON c.user_id = u.user_id AND c.song_id = s.song_id
    GROUP BY u.user_id, s.song_id"""))
def user_item_pivot(spark, d):
    # the wide matrix, its cells listed: no column of the result is named by the data
    core = core_rows(spark, d)
    songs = [r[0] for r in core.select("song_id").distinct().orderBy("song_id").collect()]  # songs_limit at most
    return ix.pivot(core, songs).unpivot(["user_id"], songs, "song_id", "play_count")


@register("binarize", ids="F9", sql=with_ctes(["core"], """
    SELECT user_id, song_id, play_count, CAST(play_count > 0 AS FLOAT) AS label FROM core"""))
def binarize(spark, d):
    return ix.binarize(core_rows(spark, d))


@register("index_ids", ids="D4", sql=with_ctes(["core"], """
    SELECT user_id, song_id, play_count,
           dense_rank() OVER (ORDER BY user_id) - 1 AS user_index,
           dense_rank() OVER (ORDER BY song_id) - 1 AS item_index
    FROM core"""))
def index_ids(spark, d):
    return ix.index_ids(core_rows(spark, d))


@register("holdout_train", ids="D1 F10", sql=with_ctes(["train"], "SELECT * FROM train"))
def holdout_train(spark, d):
    return split_rows(spark, d).where(F.col("split") == "train").select("user_id", "song_id", "play_count")


@register("holdout_test", ids="D1 F10 X9", sql=with_ctes(["test"], "SELECT * FROM test"))
def holdout_test(spark, d):
    return split_rows(spark, d).where(F.col("split") == "test").select("user_id", "song_id", "play_count")


@register("random_split", ids="D3", sql=with_ctes(["core"], f"""
    SELECT user_id, song_id, play_count,
           CASE WHEN {FRACTION_SQL.format(key="user_id || ':' || song_id || ':42'")} < 0.2
                THEN 'test' ELSE 'train' END AS split
    FROM core"""))
def random_split(spark, d):
    return ix.random_split(core_rows(spark, d), 0.2, seed=42)


@register("negative_samples", ids="D5", sql=with_ctes(["core"], f"""
    SELECT user_id, song_id, CAST(1.0 AS FLOAT) AS label FROM pos
    UNION ALL
    SELECT d.user_id, un.song_id, CAST(0.0 AS FLOAT) AS label
    FROM (SELECT p.user_id, p.song_id,
                 floor({FRACTION_SQL.format(key="p.user_id || ':' || p.song_id || ':neg:42'")}
                       * nu.n_unseen) AS r
          FROM pos p JOIN nu ON p.user_id = nu.user_id) d
    JOIN unseen un ON d.user_id = un.user_id AND d.r = un.r""", extra={
    "pos": "SELECT user_id, song_id FROM core WHERE play_count > 0",
    "items": "SELECT DISTINCT song_id FROM pos",
    "unseen": """
        SELECT u.user_id, i.song_id,
               row_number() OVER (PARTITION BY u.user_id ORDER BY i.song_id) - 1 AS r
        FROM (SELECT DISTINCT user_id FROM pos) u CROSS JOIN items i
        WHERE NOT EXISTS (SELECT 1 FROM pos p WHERE p.user_id = u.user_id AND p.song_id = i.song_id)""",
    "nu": "SELECT user_id, count(*) AS n_unseen FROM unseen GROUP BY user_id",
}))
def negative_samples(spark, d):
    return ix.negative_samples(core_rows(spark, d), seed=42)


@register("explicit_samples", ids="D6 F8", sql=with_ctes(["core"], """
    SELECT user_id, song_id, CAST(play_count AS FLOAT) AS label FROM core WHERE play_count > 0"""))
def explicit_samples(spark, d):
    return ix.explicit_samples(core_rows(spark, d))


@register("encoder_append", ids="K2 D4", sql=with_ctes(["triplets", "active"], """
    SELECT user_id, CAST(row_number() OVER (ORDER BY generation, user_id) - 1 AS BIGINT) AS code, generation FROM (
        SELECT DISTINCT user_id, CASE WHEN user_id IN (SELECT user_id FROM active) THEN 0 ELSE 1 END AS generation FROM triplets)"""))
def encoder_append(spark, d):
    # the core's users first, then those of all plays: the first codes stay
    plays, path = star.triplets(spark, d), shared_path(spark, "encoder")
    encoders.append(core_rows(spark, d), "user_id", path)
    encoders.append(plays, "user_id", path)
    return encoders.load(spark, path).withColumnRenamed("value", "user_id")


@register("triplet_files_checked", ids="S1 X6", sql=with_ctes(["triplets"], """
    SELECT length(user_id) AS folder, count(*) AS good, 2 * count(DISTINCT user_id) AS bad, count(DISTINCT user_id) AS skipped,
           CAST(sum(play_count) AS BIGINT) AS plays
    FROM triplets GROUP BY length(user_id)"""))
def triplet_files_checked(spark, d):
    """Real files with bad lines: two of each user (a short one, a count that is no number)
    and an empty one, in a folder for each length of user id."""
    plays = star.triplets(spark, d)
    users, path = plays.select("user_id").distinct(), shared_path(spark, "triplet-files")
    short, wrong = F.concat_ws("\t", "user_id", F.lit("song")), F.concat_ws("\t", "user_id", F.lit("song"), F.lit("many"))
    bad = users.select("user_id", F.explode(F.array(short, wrong, F.lit(""))).alias("value"))
    good = plays.select("user_id", F.concat_ws("\t", "user_id", "song_id", F.col("play_count").cast("string")).alias("value"))
    good.unionByName(bad).select(F.length("user_id").alias("folder"), "value").write.partitionBy("folder").text(path)
    folder = F.regexp_extract("file", r"/folder=([0-9]+)/", 1).cast("int").alias("folder")
    lines = checked.counts(spark, path, "triplets").groupBy(folder).agg(*(F.sum(c).alias(c) for c in ("good", "bad", "skipped")))
    parsed, _ = checked.read_good(spark, path, "triplets")
    return lines.join(parsed.groupBy(F.length("user_id").alias("folder")).agg(F.sum("play_count").alias("plays")), "folder")
