import hashlib
import random

import numpy as np
import pytest
import xxhash

from cases import AWKWARD, by_key, prose, table
from listenlens.llm import simhash
from listenlens.llm.components import connected_components


def brute_fingerprint(text, k=3):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if x]
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in w]
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(keys, linked):
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(keys))]


def brute(rows, radius=2):
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = components(fps, lambda a, b: (a ^ b).bit_count() <= radius)
    least = {}
    for (i, _), g in zip(rows, groups):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return [(i, f - (1 << 64) if f >> 63 else f, least[g]) for (i, _), f, g in zip(rows, fps, groups)]


def kept_by_brute_force(rows, radius=2):
    groups = components([brute_fingerprint(t) for _, t in rows], lambda a, b: (a ^ b).bit_count() <= radius)
    first = {}
    for (i, t), g in zip(rows, groups):
        address = hashlib.sha256((t or "").encode()).digest()[:16]
        key = (i is None, i or 0, address)
        if g not in first or key < first[g][0]:
            first[g] = key, (i, t)
    return [row for _, row in first.values()]


def near_copies():
    base = prose(77, 400).split()
    out = []
    for k in range(40):
        w = list(base)
        w[k * 7] = "changed"
        out.append((200 + k, " ".join(w)))
    return out


def test_matches_brute_force(spark):
    rows = [r for r in AWKWARD if r[0] not in (8, 9)] + near_copies()
    got = simhash.near_duplicates(table(spark, rows))
    want = brute(rows)
    assert by_key(got.collect()) == by_key(want)
    assert sum(c is not None and c != i for i, _, c in want) > 10  # some are linked


def test_long_texts(spark):
    rows = [r for r in AWKWARD if r[0] in (8, 9, 10)]
    assert by_key(simhash.fingerprints(table(spark, rows)).collect()) == by_key(r[:2] for r in brute(rows))


def test_fingerprint_is_spark_xxhash64(spark):
    assert spark.sql("SELECT xxhash64('one two three')").head()[0] == np.uint64(
        simhash.fingerprint("ONE two  three")).astype(np.int64)


@pytest.mark.parametrize("seed", range(8))
def test_links_keep_all_components(spark, seed):
    rng = random.Random(seed)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):  # a chain of near fingerprints
            fps.add(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {r["node"]: r["root"] for r in connected_components(simhash.links(df, 2)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    classes = lambda label: {frozenset(s for s, x in zip(signed, label) if x == y) for y in set(label)}
    assert classes([got.get(s, s) for s in signed]) == classes(want)


@pytest.mark.parametrize("n_bits,radius,size", [(16, 2, 300), (16, 1, 500), (8, 3, 200), (16, 2, 1)])
def test_bit_sliced_buckets_match_all_pairs(n_bits, radius, size):
    rng = np.random.default_rng(size)
    keys = np.sort(rng.integers(0, 4, size))
    values = rng.integers(0, 1 << n_bits, size).astype(np.uint64)
    child, parent = simhash.bucket_links(keys, values, n_bits, radius)
    want = components(list(zip(keys.tolist(), values.tolist())),
                      lambda a, b: a[0] == b[0] and (a[1] ^ b[1]).bit_count() <= radius)
    root = list(range(size))
    for c, p in zip(child.tolist(), parent.tolist()):
        root[c] = p
    classes = lambda label: {frozenset(np.flatnonzero(np.array(label) == y).tolist()) for y in set(label)}
    assert classes(root) == classes(want) and len(child) < size


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (None, 3), (2000, 2000)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1300)} == {1000} and 2000 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark):
    rows = [r for r in AWKWARD if r[0] not in (8, 9)] + near_copies()
    docs = table(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.schema.names == docs.schema.names
    assert by_key(kept.select("doc_id", "text").collect()) == by_key(kept_by_brute_force(rows))
    assert simhash.keep_one(table(spark, [])).count() == 0


def test_keep_one_names_rows_by_id_and_text(spark):
    one, other = prose(77, 400), prose(78, 400)
    near = one.split()
    near[3] = "changed"
    near = " ".join(near)
    rows = [(1, one), (2, near), (2, other),  # id 2 twice: a near copy, and a text of its own
            (None, prose(79, 300)), (None, prose(79, 300)), (None, prose(79, 299) + "end"),  # near copies without ids
            (5, prose(80, 300)), (5, prose(80, 299) + "end")]  # near copies of one id
    kept = simhash.keep_one(table(spark, rows)).select("doc_id", "text").collect()
    assert by_key(kept) == by_key(kept_by_brute_force(rows))
    assert {(1, one), (2, other)} < {tuple(r) for r in kept} and len(kept) <= 5
