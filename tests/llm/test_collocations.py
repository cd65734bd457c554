import random
import re
from collections import Counter, defaultdict

import numpy as np
from cases import AWKWARD, table

from listenlens.llm import collocations as co


def brute(rows, least=10, share=50, top=2000, depth=3):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            for m in range(1, depth + 1):
                counts["und" if lang is None else lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, c in counts.items():
        n = sum(f for p, f in c.items() if len(p) == 1)
        found = {p: f for p, f in c.items() if len(p) > 1 and f >= least}
        longer = Counter()
        for q, f in found.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    longer[q[i:i + m]] = max(longer[q[i:i + m]], f)
        kept = []
        for p, a in found.items():
            if not (longer[p] and 100 * longer[p] >= share * a):
                score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((score, a, " ".join(p), c[p[:k]], c[p[k:]]))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, x[2], x[1], x[3], x[4], n, x[0]) for i, x in enumerate(kept[:top])]
    return sorted(out)


def made(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "c", "the", "of", "x", "Élan", "z" * 40, "q\x00r"] + [f"w{i}" for i in range(60)]
    return [(rng.choice(["en", "de", None, "und"]),
             " ".join(rng.choice(words[:2 + int(rng.paretovariate(0.6)) % 60]) + rng.choice(["", "", "", ".", "\n", ";"])
                      for _ in range(rng.randint(0, 120)))) for _ in range(n)] + [("en", None), ("fr", ""), (None, None)]


def docs(spark, rows):
    return spark.createDataFrame([(t, x, "clash", "clash") for x, t in rows], "text string, lang string, route string, phrase string")


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_matches_brute_force(spark):
    rows = made(3, 500)
    got = co.collocations(docs(spark, rows).repartition(5))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert result(got) == brute(rows) and got.count() > 200
    assert result(co.collocations(docs(spark, rows), max_words=4, least=3, share=80, top=7)) == brute(rows, 3, 80, 7, 4)


def test_hot_words_and_pairs(spark, monkeypatch):
    # more than half of all pointers have one leading word, a third one pair of words
    rng = random.Random(1)
    rows = [("en", " ".join(f"hot pair w{rng.randint(0, 50)}" if rng.random() < 0.7 else f"hot v{rng.randint(0, 9)} u{rng.randint(0, 9)}"
                            for _ in range(60))) for _ in range(200)]
    texts = docs(spark, rows).select("lang", "text")
    prefixes = {r["prefix"] for r in co.heavy_prefixes(texts, 3, 8).collect()}
    assert {"hot", "hot pair", "pair", None} <= prefixes
    hot = {"en": ["hot", "hot pair", "pair"]}
    blocks = co.routed(texts, 3, 64, hot)
    sizes = [len(r["suffixes"]) / 16 for r in blocks.groupBy("route").agg({"suffixes": "max"}).toDF("route", "suffixes").collect()]
    assert len(sizes) > 30 and max(sizes) < sum(sizes) / 8
    found = {(r["phrase"], r["f"]) for r in co.frequent(texts, 3, 10, 64, hot).collect()}
    assert found == {(r["phrase"], r["f"]) for r in co.frequent(texts, 3, 10, 64, {}).collect()}
    assert result(co.collocations(docs(spark, rows))) == brute(rows)


def test_multikey_quicksort_counts_and_abandons():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 6, (3, 4000)) * (rng.random((3, 4000)) < 0.9)
    rows[0] += 1
    rows[2][rows[1] == 0] = 0
    weights = rng.integers(1, 4, 4000)
    want = Counter()
    for j in range(4000):
        for d in range(1, 4):
            if rows[d - 1, j]:
                want[tuple(rows[:d, j])] += int(weights[j])
    got = {tuple(rows[:d, i]): int(n) for d, at, f in co.multikey_quicksort(rows, weights, 40) for i, n in zip(at, f)}
    assert got == {p: n for p, n in want.items() if n >= 40} and 40 > min(want.values())
    assert list(co.multikey_quicksort(rows[:, :0], weights[:0], 1)) == []


def test_long_texts_are_cut_at_pieces(spark, monkeypatch):
    texts = [b"One two, three. " * 50, b"", b"tail"]
    words, last = co.cut(texts)
    assert words.to_pylist() == [b"one", b"two", b"three"] * 50 + [b"tail"]
    assert last.tolist() == [False, True, True] * 50 + [True]
    monkeypatch.setattr(co, "SLICE_BYTES", 100)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array([t.decode() for t in texts])], names=["lang", "text"])
    parts = list(co.slices(iter([batch])))
    assert len(parts) > 5 and sum(int((c > 0).sum()) for _, _, c in parts) == 151
    assert sum(int((c == 0).sum()) for _, _, c in parts) == 101


def test_awkward_rows(spark):
    rows = [(None if i == 7 else "en", t) for i, t in AWKWARD]
    assert result(co.collocations(table(spark, AWKWARD))) == brute([("en", t) for _, t in AWKWARD])
    assert result(co.collocations(docs(spark, rows))) == brute(rows)
    assert co.collocations(table(spark, [])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_019, 3_100_000_037, 3_000_000_077
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(co.score("a", "l", "r").alias("s")).first()
    assert row["s"] == 1_000_000 * a * a // (l * r)
