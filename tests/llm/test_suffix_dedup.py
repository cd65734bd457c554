import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, by_key, prose, table
from listenlens.llm import suffix_dedup
from listenlens.llm.suffix_dedup import REACH, WINDOW, Shard


def brute(rows):
    raws = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(r[k:k + WINDOW] for _, r in raws for k in range(len(r) - WINDOW + 1))
    out = []
    for i, r in raws:
        gone = np.zeros(len(r) + 1, np.int64)
        for k in range(len(r) - WINDOW + 1):
            if count[r[k:k + WINDOW]] > 1:
                gone[k] += 1
                gone[k + WINDOW] -= 1
        gone = np.cumsum(gone)[:len(r)] > 0
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((i, len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def planted():
    p, q, line = prose(90, 70), prose(91, 40), prose(92, 12)[:WINDOW - 1]
    exact = prose(93, 60).encode()[:WINDOW].decode(errors="ignore")
    exact = exact + "x" * (WINDOW - len(exact.encode()))
    return [
        (40, prose(80, 50) + p + prose(81, 50)), (41, p + prose(82, 50)), (42, prose(83, 9) + p), (43, p[3:]), (44, p[:-5]),
        (45, prose(84, 30) + q + prose(85, 30) + q), (46, line + prose(86, 40)), (47, prose(87, 40) + line),
        (48, exact), (49, "a" + exact + "b"), (50, exact[1:] + "c"), (51, "ab" * 400), (52, "\0" * 900), (53, "\0" * 199 + "z"),
        (54, p + "\0"), (55, p + "\0\0"), (56, prose(88, 900) + p * 3),
    ]


@pytest.mark.parametrize("hot_rows", [100_000, 3, 0])
def test_matches_brute_force(spark, hot_rows):
    rows = [r for r in AWKWARD if r[0] != 10] + planted()
    got = suffix_dedup.remove_repeats(table(spark, rows), hot_rows=hot_rows)
    want = brute(rows)
    assert by_key(got.collect()) == by_key(want)
    assert sum(0 < w[2] < w[1] for w in want) >= 8


def test_kept_bytes_and_empty_table(spark):
    rows = planted()
    for r in suffix_dedup.remove_repeats(table(spark, rows), with_kept=True).collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    assert suffix_dedup.remove_repeats(table(spark, [])).count() == 0


@pytest.mark.parametrize("memory_rows", [1 << 17, 64, 7])
def test_induced_windows_in_memory_and_on_disk(tmp_path, monkeypatch, memory_rows):
    """Rows of one shard against all pairs, with queues in memory and on disk."""
    monkeypatch.setattr(suffix_dedup, "MEMORY_ROWS", memory_rows)
    rng = random.Random(memory_rows)
    gram = bytes(rng.choices(b"xyz", k=32))
    rows = []
    for k in range(150):
        right = gram + bytes(rng.choices(b"ab", k=3)) + b"r" * rng.choice((165, 100, 10))
        left = bytes(rng.choices(b"cd", k=2)) * rng.choice((1, 20, 84)) + b"l" * rng.randint(0, 3)
        left = left[-REACH:]
        least = rng.choice((0, 1, 30, len(left)))
        rows.append((right[:WINDOW - min(least, len(left))], left[::-1], min(least, len(left)), len(left)))
    rows.sort(key=lambda r: r[0])
    shard = Shard(str(tmp_path))
    for at in range(0, len(rows), 20):
        part = rows[at:at + 20]
        meta = np.array([[0, 0, 0, 5000 << 16 | a << 8 | b] for _, _, a, b in part], np.int64).T
        shard.add([r[0] for r in part], [r[1] for r in part], meta)
    assert bool(shard.file) == (memory_rows < len(rows))
    marks = suffix_dedup.induce(shard)

    def window(row, d):
        right, left, least, most = row
        w = left[:d][::-1] + right[:WINDOW - d]
        return w if least <= d <= most and len(w) == WINDOW else None
    windows = Counter(w for r in rows for d in range(REACH + 1) if (w := window(r, d)))
    found = 0
    for i, r in enumerate(rows):
        for d in range(REACH + 1):
            w = window(r, d)
            assert bool(marks[i, d]) == (w is not None and windows[w] > 1), (i, d)
            found += bool(marks[i, d])
    assert found > 50


@pytest.mark.parametrize("length", [1, 2, 3, 32, 200, 137])
def test_string_hashes_follow_the_bytes(length):
    rng = np.random.default_rng(length)
    data = np.concatenate([rng.integers(0, 4, 400), rng.integers(0, 256, 300)]).astype(np.uint8)
    data = np.concatenate([data, data[100:500]])
    by_hash, by_bytes = {}, {}
    for i, h in enumerate(suffix_dedup.string_hashes(data, length)):
        by_hash.setdefault(int(h), set()).add(i)
        by_bytes.setdefault(data[i:i + length].tobytes(), set()).add(i)
    assert sorted(map(sorted, by_hash.values())) == sorted(map(sorted, by_bytes.values()))


def test_sample_places_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    place, h, first, last = suffix_dedup.sample_places(data, [(0, 2500), (2500, 5000)])
    windows = set()
    for p, a, b in zip(place, first, last):
        for s in range(a, b + 1):
            windows.add(s)
            alone = suffix_dedup.sample_places(data[s:s + WINDOW].copy(), [(0, WINDOW)])
            assert alone[0][0] == p - s
    assert windows == set(range(2301)) | set(range(2500, 4801))


def test_a_hash_beyond_memory_goes_through_the_disk_queues(tmp_path):
    # default settings: one hash with more places than stay in memory, two contexts in turn
    n = suffix_dedup.MEMORY_ROWS + 9_000
    assert n < suffix_dedup.HOT_ROWS
    shard = suffix_dedup.Shard(str(tmp_path))
    right = [bytes([65]) * WINDOW] * (n // 2) + [bytes([66]) * WINDOW] * (n - n // 2 - 1) + [bytes([67]) * WINDOW]
    left = [bytes([i % 3]) * 2 for i in range(n)]
    meta = np.array([[0] * n, [0] * n, [0] * n, [5000 << 16 | 0 << 8 | 2] * n], np.int64)
    for a in range(0, n, 50_000):
        shard.add(right[a:a + 50_000], left[a:a + 50_000], meta[:, a:a + 50_000])
    assert shard.file
    marks = suffix_dedup.induce(shard)
    assert marks[:-1, :3].all() and not marks[-1, 0] and not marks[:, 3:].any()
    # 198 bytes of the last context alone do not repeat
    assert not marks[-1].any()


def test_windows_of_one_hash_are_counted_by_bytes(spark, monkeypatch):
    rng = np.random.default_rng(4)
    shared = rng.integers(97, 123, 400).astype(np.uint8).tobytes().decode()
    rows = [(i, rng.integers(97, 123, 300).astype(np.uint8).tobytes().decode() + (shared if i < 4 else "")) for i in range(8)]
    want = by_key(suffix_dedup.remove_repeats(table(spark, rows)).collect())
    real = suffix_dedup.hot_windows
    monkeypatch.setattr(suffix_dedup, "hot_windows", lambda places, with_bytes=False: real(places, with_bytes).withColumn(
        "w1", F.lit(0).cast("long")).withColumn("w2", F.col("w2") % 2))  # two hashes for all windows
    assert by_key(suffix_dedup.remove_repeats(table(spark, rows), hot_rows=1).collect()) == want
    assert sum(r[2] > 0 for r in want) == 4
