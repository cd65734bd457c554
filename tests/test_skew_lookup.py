from collections import Counter

import pytest
from pyspark.sql import functions as F

from listenlens.operators import lookup, skew


@pytest.fixture()
def plain_plans(spark):
    """Sort-merge joins as planned: no broadcast by size, no plan changes at run time."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def posts(spark, n=4000):
    """``n`` documents: one word in each of them and two others."""
    ids = spark.range(n).select(F.col("id").cast("string").alias("track_id"), "id")
    words = F.array(F.lit("hot"), F.concat(F.lit("a"), F.col("id") % 997), F.concat(F.lit("b"), F.col("id") % 1009))
    return ids.select("track_id", F.explode(words).alias("word"))


def tasks(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_heavy_keys(spark):
    found = {r["word"]: r["_slices"] for r in skew.heavy_keys(posts(spark), "word", 8).collect()}
    assert found == {"hot": 22}  # a third of 64 slices
    assert skew.heavy_keys(posts(spark, 0), "word", 8).count() == 0


def test_split_join_evens_tasks(spark, plain_plans):
    left = posts(spark)
    right = left.select("word").distinct().withColumn("index", F.xxhash64("word"))
    split, plain = skew.split_join(left, right, "word"), left.join(right, "word")
    assert sorted(split.collect()) == sorted(plain.collect())
    even, uneven = tasks(split), tasks(plain)
    assert even[-1] <= 3 * even[len(even) // 2] < uneven[-1]


@pytest.mark.parametrize("how", skew.KINDS)
def test_split_join_equals_join(spark, how):
    rows = [("x", i) for i in range(300)] + [("x", 1)] * 5 + [("y", 1), ("z", 2), (None, 3), (None, None)]
    left = spark.createDataFrame(rows, "k string, slices int")
    right = spark.createDataFrame([("x", 10), ("x", 11), ("y", 12), ("w", 13), (None, 14)], "k string, u int")
    assert Counter(skew.split_join(left, right, "k", how, tasks=4).collect()) == Counter(left.join(right, "k", how).collect())
    assert skew.split_join(left.where("false"), right, "k", how).count() == 0


def test_split_join_refuses_outer(spark):
    with pytest.raises(ValueError):
        skew.split_join(posts(spark, 1), posts(spark, 1), "word", "full")


def side(plan, table):
    """Lines of the formatted plan's tree from the join to the scan of ``table``."""
    lines = plan.split("\n\n")[0].splitlines()
    at = next(i for i, x in enumerate(lines) if table in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*|"))
    path, level = [], depth(lines[at]) + 1
    for x in reversed(lines[:at + 1]):
        if depth(x) < level:
            path.append(x)
            level = depth(x)
        if "SortMergeJoin" in x:
            break
    return path


def test_lookup_without_exchange(spark, plain_plans, tmpdir_path):
    vectors = spark.range(500).select(F.col("id").cast("string").alias("track_id"), (F.col("id") * 2).alias("weight"))
    wanted = spark.createDataFrame([("u", str(i)) for i in range(0, 600, 7)], "user_id string, track_id string")
    saved = lookup.save_by_key(vectors, f"{tmpdir_path}/kept")
    again = lookup.load_by_key(spark, f"{tmpdir_path}/kept")
    for kept in (saved, again):
        joined = wanted.join(kept, "track_id")
        plan = joined._sc._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "formatted")
        path = side(plan, "Scan parquet")
        assert any("SortMergeJoin" in x for x in path) and not any("Exchange" in x for x in path), plan
        assert sorted(joined.collect()) == sorted(wanted.join(vectors, "track_id").collect())
    # saving again replaces the table's rows
    assert lookup.save_by_key(vectors.limit(3), f"{tmpdir_path}/kept").count() == 3
