"""SURVEY §5 invariants on the sf0.001 test tables, and a planted-signal ALS check."""

from pyspark.sql import functions as F

from listenlens.operators import charts, evaluate, factors, recommend, similarity
from listenlens.operators import interactions as ix
from listenlens.sources import star

SF = "/root/testdata/sf0.001"


def _core_split(spark):
    core = ix.core(star.triplets(spark, SF), 80, 50)
    split = ix.holdout_split(core, 0.2, 5, seed=42)
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    return core, train, test


def test_recommendations_unseen_and_bounded(spark):
    core, train, test = _core_split(spark)
    recs = recommend.recommend_all(train, similarity.item_cosine(train), items=core, k=10)
    assert recs.join(train, ["user_id", "song_id"]).count() == 0
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 10
    # p@k in [0, 1]; per user a multiple of 1/k
    hits = recs.join(test, ["user_id", "song_id"]).groupBy("user_id").count()
    assert all(0 <= r["count"] <= 10 for r in hits.collect())
    p = evaluate.precision_at_k(recs, test, 10).first()[0]
    assert 0.0 <= p <= 1.0


def test_holdout_partition_of_core(spark):
    core, train, test = _core_split(spark)
    assert train.count() + test.count() == core.count()
    assert train.join(test, ["user_id", "song_id"]).count() == 0
    small = core.groupBy("user_id").count().where(F.col("count") < 5).select("user_id")
    assert test.join(small, "user_id").count() == 0


def test_chart_totals_fan_out(spark):
    plays, tracks = star.triplets(spark, SF), star.tracks(spark, SF)
    totals = charts.track_totals(plays, tracks).agg(F.sum("play_count")).first()[0]
    per_song = tracks.groupBy("song_id").count()
    expect = plays.join(per_song, "song_id").agg(F.sum(F.col("play_count") * F.col("count"))).first()[0]
    assert totals == expect


def test_als_beats_popularity_on_planted_groups(spark):
    # two taste groups: users of group g hear items of group g only, each user
    # missing exactly 2 of the 10 items of the group
    rows = []
    for u in range(40):
        g = u % 2
        for i in range(20):
            if i % 2 == g and (u * 7 + i * 3) % 5 != 0:
                rows.append((f"u{u:02d}", f"i{i:02d}", 1.0))
    df = spark.createDataFrame(rows, "user_id string, song_id string, label double")
    recs = factors.als_recommend(df, df.withColumnRenamed("label", "play_count"), top=2,
                                 rank=4, max_iter=10, seed=42)
    own = recs.where((F.substring("user_id", 2, 2).cast("int") % 2)
                     == (F.substring("song_id", 2, 2).cast("int") % 2)).count()
    assert own / recs.count() > 0.9
