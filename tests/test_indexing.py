import random

from pyspark.sql import functions as F

from listenlens.functions import dense_index
from listenlens.functions.ranking import rank_within
from listenlens.sources import parse_lyrics_lines
from listenlens.sources.files import bad_postings


def test_dense_index_consecutive_in_order(spark):
    keys = random.Random(5).sample(range(100000), 1000)
    df = spark.createDataFrame([(f"k{k:06d}",) for k in keys], "key string")
    out = sorted((r.idx, r.key) for r in dense_index(df, ["key"], base=1, num_partitions=7).collect())
    assert [i for i, _ in out] == list(range(1, 1001))
    assert [k for _, k in out] == sorted(k for _, k in out)


def test_rank_within_groups(spark):
    rows = [(g, i) for g in ("a", "b", "c") for i in range(50 if g == "a" else 5)]
    df = spark.createDataFrame(rows, "g string, v int")
    out = rank_within(df, "g", [F.desc("v")]).collect()
    for r in out:
        n = 50 if r.g == "a" else 5
        assert r["rank"] == n - r.v


def test_malformed_postings_do_not_fail(spark):
    lines = spark.createDataFrame([("A,1,1:2,x:3,4:y",)], "value string")
    parsed = parse_lyrics_lines(lines)
    assert parsed.where(F.col("word_index").isNotNull() & F.col("count").isNotNull()).count() == 1
    assert bad_postings(parsed).count() == 2
