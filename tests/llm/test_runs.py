import hashlib
import random
import zlib

import pytest
from cases import AWKWARD, table

from listenlens.llm import runs
from listenlens.llm.runs import Run, find_runs


def brute(words, least_words=6, least_periods=4):
    found = []
    for p in range(1, len(words) // 2 + 1):
        i = p
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - p]:
                j += 1
            start, length = i - p, j - i + p
            if j > i and length >= max(least_words, least_periods * p) and not any(
                    all(words[x] == words[x - d] for x in range(start + d, start + length)) for d in range(1, p)):
                found.append(Run(start, length, p))
            i = j + 1
    return sorted(found)


def made(rng, mode, n):
    if mode == 0:
        return [rng.choice("ab") for _ in range(n)]
    if mode == 1:
        return [rng.choice("aaab") for _ in range(n)]
    words = []
    while len(words) < n:
        x = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        if mode == 3:
            x = x * rng.randint(1, 4) + [rng.choice("ab")]
        words += (x * 7)[:rng.randint(1, 6 * len(x))]
    return words


@pytest.mark.parametrize("least", [(6, 4), (1, 2), (2, 3)])
def test_runs_match_brute_force(least):
    rng, n = random.Random(5), 0
    for i in range(800):
        words = made(rng, i % 4, rng.randint(0, 70))
        got = find_runs(words, *least)
        n += len(got)
        assert got == brute(words, *least), words
    assert n > 400


def test_the_catcher_alone_finds_all_squares():
    rng = random.Random(9)
    for i in range(300):
        words = made(rng, i % 4, rng.randint(0, 50))
        catcher, found = runs.SquareCatcher(len(words) // 2), []
        for k, w in enumerate(words):
            ended = catcher.append(w)
            assert all(r.start + r.length == k for r in ended)  # reported as soon as the run ends
            found += ended
        assert sorted(found + catcher.finish()) == brute(words, 2, 2)


def test_long_texts():
    assert find_runs(["a"] * 30_000) == [Run(0, 30_000, 1)]
    assert find_runs([str(i % 997) for i in range(20_000)]) == [Run(0, 20_000, 997)]
    words = (["a"] * 50 + ["b"]) * 100
    assert find_runs(words)[0] == Run(0, 50, 1) and Run(0, 5_100, 51) in find_runs(words) and len(find_runs(words)) == 101


def expected(doc_id, text):
    words = runs.WORD.findall(text or "")
    if doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = sorted(found, key=lambda r: (-r.length, r.start, r.period))[:1]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    longest = (*best[0], 1000 * best[0].length // best[0].period) if best else (None,) * 4
    return (doc_id, len(found), *longest, digest("".join("%d,%d,%d\n" % r for r in found)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_rows_match_brute_force(spark):
    rng = random.Random(2)
    rows = [r for r in AWKWARD if len(r[1] or "") < 5000] + [(i, " ".join(made(rng, i % 4, 60))) for i in range(100, 260)]
    docs = table(spark, rows)
    got = runs.detect(docs, tile=runs.tiled)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(expected(*r)) for r in rows)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    plain = {r["doc_id"]: r for r in runs.detect(docs, with_text=True).where("doc_id is not null").collect()}
    assert plain[4]["n_runs"] == 0 and plain[4]["start"] is None and plain[4]["collapsed"] == ""
    assert runs.detect(table(spark, []), tile=runs.tiled).count() == 0


def test_collapsed_text(spark):
    docs = table(spark, [(1, "so it is " * 5 + "then"), (9, "word " * 3000), (10, "x" * 60_000)])
    got = {r["doc_id"]: r for r in runs.detect(docs, with_text=True).collect()}
    assert got[1]["collapsed"] == "so it is then" and (got[1]["period"], got[1]["length"]) == (3, 15)
    assert got[9]["collapsed"] == "word" and got[9]["exponent_milli"] == 3_000_000
    assert got[10]["n_runs"] == 0
