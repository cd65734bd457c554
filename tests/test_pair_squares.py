"""Pairs counted, weighed and multiplied in squares of the vocabulary, against brute force."""

import math
import random
from collections import Counter

import pytest

from listenlens.operators import cooccurrence


def brute(rows, window, least):
    c = Counter(w for r in rows for w in r or [])
    n = Counter()
    for r in rows:
        for i, a in enumerate(r or []):
            for b in (r or [])[i + 1:i + 1 + window]:
                if a != b and c[a] >= least and c[b] >= least:
                    n[a, b] += 1
                    n[b, a] += 1
    return n


def sentences():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)] + ["ä", "日本", "", "hot"]
    weights = [1 / (i + 1) for i in range(60)] + [0.2, 0.2, 0.1, 2]
    return [rng.choices(words, weights, k=rng.randint(0, 15)) for _ in range(400)] + [[f"rare{i}" for i in range(40)], [], None, ["hot"] * 9]


@pytest.fixture
def small(monkeypatch):
    # several texts' rows in a task, many squares, several squares to a task of a product
    monkeypatch.setattr(cooccurrence, "WORDS_AT_ONCE", 60)
    monkeypatch.setattr(cooccurrence, "PAIRS_PER_SQUARE", 300)
    monkeypatch.setattr(cooccurrence, "PAIRS_PER_PRODUCT", 20)


def frame(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "words array<string>").repartition(3)


@pytest.mark.parametrize("window,least", [(1, 1), (4, 5)])
def test_counts_of_many_squares(spark, small, window, least):
    rows = sentences()
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = frame(spark, rows).mapInArrow(seen, "words array<string>")
    got = cooccurrence.pair_counts(df, window=window, min_count=least)
    assert {(r["word"], r["other"]): r["n"] for r in got.collect()} == dict(brute(rows, window, least))
    assert read.value == len(rows)  # the texts are read once, for the words' counts and the pairs


def test_messages_are_packed(spark, small):
    # a row for each square that a task's texts reach, not for each pair
    rows = sentences()
    messages, _, sides = cooccurrence._messages_of(frame(spark, rows), "words", 4, 5)
    sent = messages.collect()
    counts = [int.from_bytes(r["n"][:8], "little") for r in sent]
    assert sides >= 8 and all(counts) and sum(counts) > 3 * len(sent)
    assert counts == [int.from_bytes(r["keys"][:8], "little") for r in sent]


def test_weights_of_squares(spark, small):
    rows = sentences()
    want = brute(rows, 3, 4)
    single, total = Counter(), sum(want.values())
    for (a, _), n in want.items():
        single[a] += n
    weights = {p: math.log(n * total / (single[p[0]] * single[p[1]])) for p, n in want.items()}
    got = cooccurrence.information(cooccurrence.pair_counts(frame(spark, rows), window=3, min_count=4, packed=True)).collect()
    found = {(r["word"], r["other"]): (r["n"], r["weight"]) for r in got}
    assert len(found) == len(got) and found.keys() == {p for p, w in weights.items() if w > 0}
    assert all(n == want[p] and math.isclose(w, weights[p]) for p, (n, w) in found.items())


def test_empty_squares(spark):
    for rows in ([], [["a"]], [None]):
        counts = cooccurrence.pair_counts(frame(spark, rows), packed=True)
        assert cooccurrence.information(counts).count() == 0
