"""Co-occurrence counts, weights and vectors against brute force."""

import math
import random
from collections import Counter

import numpy as np

from listenlens.operators import cooccurrence

SCHEMA = "words array<string>, other string, n string"


def sentences():
    rng = random.Random(4)
    rows = []
    for _ in range(150):  # two topics that never meet
        words = rng.choice([["sun", "sea", "sand", "wave"], ["snow", "ski", "ice", "frost"]])
        rows.append([rng.choice(words) for _ in range(rng.randint(0, 9))])
    return rows + [["once", "sun", "twice"], [], None, ["alone"], ["same"] * 30, ["long"] + ["sun", "sea"] * 2000]


def brute(rows, window, least):
    rows = [r or [] for r in rows]
    c = Counter(w for r in rows for w in r)
    n = Counter()
    for r in rows:
        for i, a in enumerate(r):
            for b in r[i + 1:i + 1 + window]:
                if a != b and c[a] >= least and c[b] >= least:
                    n[a, b] += 1
                    n[b, a] += 1
    return n


def test_counts_and_weights(spark):
    rows = sentences()
    df = spark.createDataFrame([(r, "clash", "clash") for r in rows], SCHEMA)
    for window, least in ((1, 1), (3, 1), (4, 5)):
        want = brute(rows, window, least)
        got = cooccurrence.pair_counts(df, window=window, min_count=least)
        assert {(r["word"], r["other"]): r["n"] for r in got.collect()} == dict(want)
    single, total = Counter(), sum(want.values())
    for (a, _), n in want.items():
        single[a] += n
    weights = {p: math.log(n * total / (single[p[0]] * single[p[1]])) for p, n in want.items()}
    found = {(r["word"], r["other"]): r["weight"] for r in cooccurrence.information(got).collect()}
    assert found.keys() == {p for p, w in weights.items() if w > 0}
    assert all(math.isclose(w, weights[p]) for p, w in found.items())


def test_words_of_a_topic_are_near(spark):
    df = spark.createDataFrame([(r, "clash", "clash") for r in sentences()], SCHEMA)
    table = cooccurrence.word_vectors(cooccurrence.information(cooccurrence.pair_counts(df, window=3, min_count=5)), 3)
    v = {r["word"]: np.array(r["vector"]) / np.linalg.norm(r["vector"]) for r in table.collect()}
    warm, cold = ("sand", "wave"), ("snow", "ski", "ice", "frost")
    assert set(warm) | set(cold) <= set(v)
    assert all(v[a] @ v[b] < 0.3 for a in warm for b in cold)
    assert sum(v[a] @ v[b] for a in cold for b in cold) / 16 > 0.4


def test_empty(spark):
    none = cooccurrence.information(cooccurrence.pair_counts(spark.createDataFrame([], SCHEMA)))
    assert none.count() == 0 and cooccurrence.word_vectors(none, 2).count() == 0


def test_pairs_are_kept_in_one_direction(spark, monkeypatch):
    written, real = [], getattr(cooccurrence, "_written", None)
    monkeypatch.setattr(cooccurrence, "_written", lambda df: written.append(real(df)) or written[-1])
    df = spark.createDataFrame([(["a", "b", "c", "a"],), (["b", "a"],)], "words array<string>")
    counts = cooccurrence.pair_counts(df, window=2)
    weights = cooccurrence.information(counts)
    both = {(r["word"], r["other"]) for r in counts.collect()}
    assert {tuple(r) for r in written[0].select("word", "other").collect()} == {p for p in both if p[0] < p[1]}
    found = {(r["word"], r["other"]): r["weight"] for r in weights.collect()}
    assert found and all(found[b, a] == w for (a, b), w in found.items())
    assert weights.where("weight <= 0").count() == 0


def test_rare_words_make_no_pairs_and_batches_add_up(spark, monkeypatch):
    # pairs of words under min_count are not even sent; texts over several batches and tasks
    monkeypatch.setattr(cooccurrence, "WORDS_AT_ONCE", 50)
    rng = random.Random(9)
    rows = [[f"rare{n}", "ä", None, rng.choice(["sun", "Sea", "é"]), f"odd{n}", rng.choice(["sun", "ä"])] for n in range(300)]
    df = spark.createDataFrame([(r,) for r in rows], "words array<string>").repartition(3)
    kept = spark.createDataFrame([(w,) for w in ("sun", "Sea", "ä", "é")], "a string")
    flags = cooccurrence._bitmap(kept)
    assert 1 <= flags.sum() <= 4
    sent = [b for r in rows for b in cooccurrence._count_pairs([cooccurrence.pa.array([r])], 4, flags)]
    assert sum(b.num_rows for b in sent) < 2_000  # 300 x 10 with the rare words
    got = {(r["word"], r["other"]): r["n"] for r in cooccurrence.pair_counts(df, window=4, min_count=20).collect()}
    want = brute([[x or f"none{n}" for x in r] for n, r in enumerate(rows)], 4, 20)
    assert got == dict(want)
