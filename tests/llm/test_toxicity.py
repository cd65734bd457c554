import zlib

import numpy as np
import pytest
from cases import AWKWARD, by_key, prose, table

from listenlens.llm import toxicity as tx

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{n}.parquet") for n in ("documents", "labels"))
    return docs, labels, {r["doc_id"]: r for r in tx.judge(docs, labels).collect()}


def test_held_out_accuracy(judged):
    docs, labels, got = judged
    assert len(got) == docs.count()
    held = [(got[r["doc_id"]], r["toxic"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert len(held) > 40
    assert sum(g["predicted"] == t for g, t in held) / len(held) > 0.9
    bad, good = [g["score"] for g, t in held if t], [g["score"] for g, t in held if not t]
    auc = sum((b > g) + (b == g) / 2 for g in good for b in bad) / (len(good) * len(bad))
    # a part of the rows labelled toxic hold nothing that others of the label hold: a score cannot tell them
    assert auc > 0.75
    for i, g in got.items():
        assert g["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and g["predicted"] == int(g["score"] >= 0.5)


def test_held_out_labels_are_not_learned(judged):
    docs, labels, got = judged
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id as string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    again = {r["doc_id"]: r["score"] for r in tx.judge(docs, flipped).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in got.items())


def grams(text):
    text = f" {' '.join(text.lower().split())} "
    return {text[i:i + n] for n in tx.SIZES for i in range(len(text) - n + 1)}


def test_n_grams_and_ratios_match_brute_force(spark):
    texts = [(i % 3 == 0, prose(i, 30) + (" vile" if i % 3 == 0 else "")) for i in range(60)]
    rows = spark.createDataFrame([(int(t), 1.0, x) for t, x in texts], "label int, weight double, text string").repartition(3)
    p = {True: {}, False: {}}
    for t, x in texts:
        for g in grams(x):
            p[t][g] = p[t].get(g, 0) + 1
    every = set(p[True]) | set(p[False])
    hash_of = {g: int(h) for g in every for h in _hash(g)}
    counts = tx.gram_counts(rows)
    got = {r["h"] % 2**64: (r["p"], r["q"]) for r in counts.collect()}
    assert got == {hash_of[g]: (p[True].get(g, 0), p[False].get(g, 0)) for g in every}
    sums = [sum(p[t].get(g, 0) + 1 for g in every) for t in (True, False)]
    h, r = tx.ratios(counts, 5, 2.0, 1000)
    known = {hash_of[g]: g for g in every}
    assert "vile" in {known[int(x)] for x in h} and list(h) == sorted(h)
    for x, ratio in zip(h, r):
        a, b = (p[t].get(known[int(x)], 0) + 1 for t in (True, False))
        assert ratio == pytest.approx(np.log(a / sums[0]) - np.log(b / sums[1]))
        assert a + b - 2 >= 5 and abs(ratio) / np.sqrt(1 / a + 1 / b) >= 2.0


def _hash(gram):
    """The hash of one n-gram alone."""
    points = (np.array([ord(c) for c in gram], np.uint64) + np.uint64(1)) * tx._MIX
    points ^= points >> np.uint64(32)
    rolled = points[:1]
    for x in points[1:]:
        rolled = rolled * tx._STEP + x
    return (rolled ^ (rolled >> np.uint64(29))) * tx._MIX


def test_present_and_slices(monkeypatch):
    text = prose(1, 400) + " 🎉 ÀB\t\n c"
    whole = np.unique(np.concatenate(list(tx.gram_hashes(text))))
    assert len(whole) == len(grams(text))
    monkeypatch.setattr(tx, "SLICE", 37)
    assert np.array_equal(np.unique(np.concatenate(list(tx.gram_hashes(text)))), whole)
    one = np.unique(whole >> np.uint64(64 - tx.SLOT_BITS), return_index=True)[1]
    model = np.sort(whole[one])[::2]
    assert tx.Lookup(model).present(text).tolist() == list(range(len(model)))
    assert tx.Lookup(model).present("").tolist() == []


def test_awkward_rows(spark):
    rows = AWKWARD + [(100 + i, prose(i, 50) + (" you vile moron" if i % 4 == 0 else "")) for i in range(160)]
    labels = spark.createDataFrame([(100 + i, 1, int(i % 4 == 0)) for i in range(160)] + [(None, 1, 0), (4, 1, None), (9999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = tx.judge(table(spark, rows), labels).collect()
    assert by_key((r["doc_id"],) for r in got) == by_key((i,) for i, _ in rows)
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert all(r["predicted"] == int((r["doc_id"] - 100) % 4 == 0) for r in got if r["doc_id"] and r["doc_id"] >= 100)
    one = tx.judge(table(spark, rows), labels.where("toxic = 1")).collect()
    assert {r["predicted"] for r in one} == {1}
    assert {r["score"] for r in tx.judge(table(spark, rows), labels.limit(0)).collect()} == {0.5}
    assert tx.judge(table(spark, []), labels).count() == 0
