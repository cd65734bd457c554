"""The word vectors from packed weights against those of a numpy decomposition."""

import random

import numpy as np
import pytest

from listenlens.operators import cooccurrence, factors


def sentences():
    rng = random.Random(5)
    return [rng.choices([f"w{i}" for i in range(50)], [1 / (i + 2) for i in range(50)], k=12) for _ in range(300)] + [["once", "twice"]]


@pytest.mark.parametrize("per_task", [16_000_000, 20])
def test_vectors_equal_the_decomposition(spark, monkeypatch, per_task):
    monkeypatch.setattr(cooccurrence, "PAIRS_PER_SQUARE", 300)
    monkeypatch.setattr(cooccurrence, "PAIRS_PER_PRODUCT", per_task)
    df = spark.createDataFrame([(s,) for s in sentences()], "words array<string>").repartition(2)
    counts = cooccurrence.pair_counts(df, window=3, min_count=3, packed=True)
    rows = cooccurrence.information(counts).collect()
    words = sorted({r["word"] for r in rows})
    x = np.zeros((len(words), len(words)))
    for r in rows:
        x[words.index(r["word"]), words.index(r["other"])] = r["weight"]
    # no row per pair meets a vector: the general product, which joins them, is not asked
    monkeypatch.setattr(factors, "_weighted_sum", lambda *a: pytest.fail("a row per pair"))
    got = {r["word"]: r["vector"] for r in cooccurrence.word_vectors(cooccurrence.information(counts, packed=True), 18).collect()}
    assert sorted(got) == words  # words without a weight have no vector
    v = np.array([got[w] for w in words])
    u, s, _ = np.linalg.svd(x)
    assert len(words) < 54  # the search space is the whole row space: exact
    assert np.allclose(v @ v.T, u[:, :18] * s[:18] @ u[:, :18].T, atol=1e-6)


def test_empty(spark):
    none = cooccurrence.pair_counts(spark.createDataFrame([], "words array<string>"), packed=True)
    assert cooccurrence.word_vectors(cooccurrence.information(none, packed=True), 2).count() == 0
