import math
import zlib

import pytest

from cases import AWKWARD, by_key, prose, table
from listenlens.llm import quality_classifier as qc

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{n}.parquet") for n in ("documents", "labels"))
    return docs, labels, {r["doc_id"]: r for r in qc.judge(docs, labels).collect()}


def test_held_out_accuracy(judged):
    _, labels, got = judged
    rows = [(got[r["doc_id"]], r["quality"]) for r in labels.collect()]
    held = [(g["score"], q) for g, q in rows if g["held_out"]]
    assert len(held) > 40 and all(0 <= s <= 1 for s, _ in held)
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95
    assert sum((s >= 0.3) == q for s, q in held) / len(held) > 0.95
    for g, _ in rows:
        assert g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 5 == 0)
        assert g["predicted"] == int(g["score"] >= 0.3)


def test_held_out_labels_are_not_learned(spark, judged):
    docs, labels, got = judged
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id as string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    again = {r["doc_id"]: r["score"] for r in qc.judge(docs, flipped).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in got.items())


def test_rules_of_a_tree():
    tree = """DecisionTreeClassificationModel: depth=2
  If (feature 2 <= 0.5)
   If (feature 0 <= 19.5)
    Predict: 0.0
   Else (feature 0 > 19.5)
    Predict: 1.0
  Else (feature 2 > 0.5)
   If (feature 2 <= 1.5E1)
    Predict: 0.0
   Else (feature 2 > 1.5E1)
    Predict: 1.0
"""
    inf = math.inf
    assert [r.bounds for r in qc.path_rules(tree, "abc")] == [
        (("c", -inf, 0.5),), (("a", -inf, 19.5), ("c", -inf, 0.5)), (("a", 19.5, inf), ("c", -inf, 0.5)),
        (("c", 0.5, inf),), (("c", 0.5, 15.0),), (("c", 15.0, inf),)]


def test_column_is_the_sum_of_rules(spark):
    model = qc.RuleEnsemble(0.25, ((qc.Rule((("upper", 0.5, math.inf),)), 2.0), (qc.Rule((("n_words", 1.0, 3.0),)), -1.0)))
    df = spark.createDataFrame([(0.6, 2.0), (0.5, 1.0), (0.4, 3.0)], "upper double, n_words double")
    z = [0.25 + 2 - 1, 0.25, 0.25 - 1]
    assert [r[0] for r in df.select(model.score()).collect()] == pytest.approx([1 / (1 + math.exp(-x)) for x in z])


def test_awkward_rows(spark):
    rows = AWKWARD + [(100 + i, prose(i, 50) if i % 4 else "!!! ### " * 30) for i in range(120)]
    labels = spark.createDataFrame([(100 + i, int(i % 4 > 0), 0) for i in range(120)] + [(None, 1, 0), (4, None, 0), (9999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = qc.judge(table(spark, rows), labels).collect()
    assert by_key((r["doc_id"],) for r in got) == by_key((i,) for i, _ in rows)
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert all(r["predicted"] == int((r["doc_id"] - 100) % 4 > 0) for r in got if r["doc_id"] and r["doc_id"] >= 100)
    one = qc.judge(table(spark, rows), labels.where("quality = 1")).collect()
    assert {r["predicted"] for r in one} == {1}
    assert {r["score"] for r in qc.judge(table(spark, rows), labels.limit(0)).collect()} == {0.5}
    assert qc.judge(table(spark, []), labels).count() == 0
