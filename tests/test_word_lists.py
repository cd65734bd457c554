"""The adapter's word lists against the SQL's split, and how they are made."""

import random
import re

from listenlens.sources import star

STOPS = ["the", "of"]


def texts():
    rng = random.Random(8)
    odd = ["", None, "a", "The", "of the OF", "x-y", "  lead", "trail  ", "é", "aéb", "Kelvin", "İstanbul", "日本go日", "a\nb\tc", "9", "z" * 300, "o'Neil"]
    return odd + ["".join(rng.choice("aBt é-\nK`{z9") for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["", None]


def test_words_of_odd_texts(spark, tmpdir_path):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts(), 1)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmpdir_path}/documents.parquet")
    got = star.word_lists(spark, tmpdir_path, STOPS)
    # the texts' bytes are cut, without a regular expression and a row function
    assert "split(" not in got._jdf.queryExecution().executedPlan().toString()
    lower = {r[0]: r[1] for r in spark.createDataFrame(rows, "i long, t string").selectExpr("t", "lower(t)").collect()}
    want = sorted((str(i) if i else "", [w for w in re.split("[^a-z]+", lower[t] or "") if w and w not in STOPS]) for i, t in rows)
    assert sorted((r["track_id"] or "", r["words"]) for r in got.collect()) == want


def test_no_stop_words_and_no_texts(spark, tmpdir_path):
    spark.createDataFrame([(1, "The of")], "doc_id long, text string").write.parquet(f"{tmpdir_path}/documents.parquet")
    assert [r["words"] for r in star.word_lists(spark, tmpdir_path, []).collect()] == [["the", "of"]]
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmpdir_path}/none/documents.parquet")
    assert star.word_lists(spark, f"{tmpdir_path}/none").count() == 0


def test_texts_of_given_documents_only(spark, tmpdir_path):
    rows = [(i, "sun sea") for i in range(9)] + [(None, "sand")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmpdir_path}/documents.parquet")
    ids = spark.createDataFrame([("3", 1), ("3", 2), ("40", 1), (None, 1)], "track_id string, n int")
    got = star.word_lists(spark, tmpdir_path, ids=ids)
    assert [tuple(r) for r in got.collect()] == [("3", ["sun", "sea"])]
    # the other documents' texts are left out below the step that cuts them
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("LeftSemi")
