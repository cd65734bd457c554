import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import AWKWARD, by_key, table
from listenlens.llm import packing


def brute_pieces(rows, capacity):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def test_pieces_and_places(spark):
    rows = [r for r in AWKWARD if r[0] != 10] + [(300, "a" * 200)]
    for capacity in (2048, 64):
        got = packing.pack(table(spark, rows), capacity=capacity).collect()
        want = brute_pieces(rows, capacity)
        assert by_key(tuple(r)[:5] for r in got) == by_key(want)
        sequences = defaultdict(list)
        for r in got:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for own in sequences.values():
            at = 0
            for offset, length in sorted(own):  # gapless from 0
                assert offset == at
                at += length
            assert at <= capacity
        total = sum(w[3] for w in want)
        assert len(sequences) <= -(-total // capacity) + 1 + sum(w[3] * 2 > capacity for w in want)


def test_ids_and_empty_table(spark):
    docs = table(spark, AWKWARD[:3])
    for r in packing.pack(docs, keep_ids=True).collect():
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    empty = packing.pack(table(spark, []))
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "piece"]


def test_fast_encoder_gives_the_tokenizers_ids():
    encode = packing._encoder(None, None)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    chars = [chr(c) for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000] + ["\n", "\t", "  ", "'s", "<|endoftext|>", "🎉"]
    for _ in range(3000):
        text = "".join(rng.choice(chars) for _ in range(rng.randint(0, 40)))
        assert encode(text).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]


def optimum(items, capacity):
    """Exact bin packing of a few items, by trying all assignments."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                go(i + 1, bins[:k] + [bins[k] + items[i]] + bins[k + 1:])
        go(i + 1, bins + [items[i]])
    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_an_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice((10, 17, 30))
    items = [rng.randint(max(1, capacity // 6), capacity) for _ in range(rng.randint(0, 11))]
    fixed, left = packing.reduce_instance(Counter(items), capacity)
    used = Counter(left)
    for times, content in fixed:
        assert sum(w * c for w, c in content) <= capacity
        for w, c in content:
            used[w] += times * c
    assert used == Counter(items)
    rest = [w for w, n in left.items() for _ in range(n)]
    assert sum(t for t, _ in fixed) + optimum(rest, capacity) == optimum(items, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_matches_one_by_one(seed):
    rng = random.Random(seed)
    capacity = 50
    items = sorted((rng.randint(1, capacity) for _ in range(200)), reverse=True)
    bins = []
    for w in items:
        fit = [k for k, b in enumerate(bins) if b + w <= capacity]
        if fit:
            bins[max(fit, key=lambda k: bins[k])] += w
        else:
            bins.append(w)
    got = packing.best_fit(Counter(items), capacity)
    loads = list(itertools.chain.from_iterable([sum(w * c for w, c in content)] * times for times, content in got))
    assert sorted(loads) == sorted(bins)
    slots = packing._slots(got)
    assert len({tuple(s[:2]) for s in slots.tolist()}) == len(slots)


def test_large_counts_stay_small():
    counts = {w: 10**9 + w for w in range(1, 2049)}
    patterns = packing.plan(counts)
    total = sum(w * n for w, n in counts.items())
    assert sum(t for t, _ in patterns) <= -(-total // 2048) * 1.0001 + 1 and len(patterns) < 10_000
