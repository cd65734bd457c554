"""Phrase collocations by multikey quicksort of suffix pointers.

Every word of a text is a pointer to the suffix of its piece; a suffix counts up to
``max_words`` words deep.  Tasks route the pointers by the leading words: all suffixes
with one leading word meet in one route, but those of a word that holds more than a
route's share are routed by two words, and so on (the hot prefixes, found in a first
pass, are few: at most two per route).  In a route a multikey three-way quicksort
partitions the pointers word by word; the size of an equal-partition is the count of
its prefix, and partitions of fewer than ``least`` pointers are abandoned, so no rare
word or phrase is sorted out.  Equal suffixes of a batch travel as one with a count.

Counts, cuts and scores follow on the frequent phrases as DataFrames; scores use
decimals of 38 digits (exact up to counts of 10^15).

Defined results
---------------
* null or empty text: no word; null language: ``und`` (together with that name);
* a language without a candidate: no row; an empty table: empty result;
* repeated rows count again; null and equal ids do not matter (no id is read), nor do
  other columns; ties: by score, count, then phrase in byte order;
* words of any length count as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlens import session
from listenlens.llm.common import map_batches, written

#: Words of a route at most, but for one prefix; at least this many routes.
ROUTE_WORDS, LEAST_ROUTES = 1 << 20, 32
#: Hot prefixes of one length at most: those with this share of all words.
MOST_HOT = 1 << 20
#: Tasks that a language's phrases are dealt to before they are ranked.
DEALS = 64
#: Text bytes cut into words at once.
SLICE_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 1: between words, 2: between pieces
_KIND[[32, 9]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")


def cut(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of the texts, one after the other, and whether each is the
    last of its piece."""
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kind = _KIND[raw]
    inside = kind == 0
    starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])))
    ends = np.flatnonzero(~inside & np.concatenate(([False], inside[:-1])))
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    breaks = np.cumsum(kind == 2)
    last = np.ones(len(starts), bool)
    if len(starts):
        last[:-1] = breaks[starts[1:]] > breaks[starts[:-1]]
    return words, last


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str], np.ndarray]]:
    """``(language, distinct words, codes)`` of slices of the texts of one language; code 0
    stands after the last word of a piece, word i has code i + 1."""

    def coded(lang: str, texts: list[bytes]):
        words, last = cut(texts)
        table = words.dictionary_encode()
        codes = np.zeros(len(words) + int(last.sum()), np.int64)
        codes[np.arange(len(words)) + np.concatenate(([0], np.cumsum(last)[:-1])).astype(np.int64)[:len(words)]] = (
            table.indices.to_numpy() + 1)
        return lang, table.dictionary.to_pylist(), codes

    for batch in batches:
        held: dict[str, tuple[list, list]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            texts, sizes = held.setdefault(lang, ([], [0]))
            at = 0
            while at < len(raw):
                end = _BREAK.search(raw, at + SLICE_BYTES)  # long texts go on at a piece's end
                texts.append(raw[at:end.start() if end else len(raw)])
                at = end.end() if end else len(raw)
                sizes[0] += len(texts[-1])
                if sizes[0] >= SLICE_BYTES:
                    yield coded(lang, texts)
                    texts.clear()
                    sizes[0] = 0
        for lang, (texts, _) in held.items():
            yield coded(lang, texts)


def suffixes(codes: np.ndarray, depth: int) -> np.ndarray:
    """``(depth, n)``: the first words of every suffix, 0 from the end of its piece on."""
    at = np.flatnonzero(codes)
    found = np.zeros((depth, len(at)), np.int64)
    padded = np.concatenate((codes, np.zeros(depth, codes.dtype)))
    open_ = np.ones(len(at), bool)
    for k in range(depth):
        found[k] = np.where(open_, padded[at + k], 0)
        open_ &= found[k] > 0
    return found


def _equal(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``rows`` (values below ``width``) and their numbers."""
    groups = np.zeros(rows.shape[1], np.int64)
    for row in rows:
        _, groups = np.unique(groups * width + row, return_inverse=True)
    _, first, n = np.unique(groups, return_index=True, return_counts=True)
    return rows[:, first], n


def heavy_prefixes(texts: DataFrame, depth: int, share: int) -> DataFrame:
    """``(lang, prefix, n)``: all words of each language (prefix null), and every prefix of
    1 to ``depth`` - 1 words that some slice has in over 1 / ``share`` of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes in slices(batches):
            found = suffixes(codes, depth - 1)
            total = found.shape[1]
            rows = [(None, total)]
            held = np.ones(total, bool)
            groups = np.zeros(total, np.int64)
            for k in range(depth - 1):
                held &= found[k] > 0
                _, first, groups, n = np.unique(groups * (len(words) + 1) + found[k], return_index=True, return_inverse=True,
                                                return_counts=True)
                held &= n[groups] * share > total
                for i in np.flatnonzero((n * share > total) & held[first]):
                    rows.append((b" ".join(words[c - 1] for c in found[:k + 1, first[i]]).decode("utf-8", "surrogatepass"), int(n[i])))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows)), pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.int64())], names=["lang", "prefix", "n"])

    sums = map_batches(texts, run, "lang string, prefix string, n long").groupBy("lang", "prefix").agg(F.sum("n").alias("n"))
    return written(sums, "phrase-prefixes")


def _route(key: bytes, routes: int) -> int:
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big") % routes


def routed(texts: DataFrame, depth: int, routes: int, hot: dict[str, list[str]]) -> DataFrame:
    """Blocks ``(route, lang, words, suffixes)``: the distinct suffixes of a slice that go
    to one route, as ``depth`` places in ``words`` (0: none) and a count each; for a hot
    prefix also a row of the prefix itself, with -1 after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_of = {lang: {tuple(p.encode("utf-8", "surrogatepass").split(b" ")) for p in found} for lang, found in hot.items()}
        for lang, words, codes in slices(batches):
            if not words:
                continue
            place = {w: i + 1 for i, w in enumerate(words)}
            key = lang.encode() + b"\x00"
            rows, n = _equal(suffixes(codes, depth), len(words) + 1)
            by_word = np.array([0] + [_route(key + w, routes) for w in words], np.int64)
            route = by_word[rows[0]]
            # the hot prefixes of this slice, shorter ones first: one word more decides
            for prefix in sorted(hot_of.get(lang, ()), key=len):
                if all(w in place for w in prefix):
                    under = np.flatnonzero(np.all(rows[:len(prefix)] == [[place[w]] for w in prefix], axis=0))
                    following = rows[len(prefix), under]
                    for c in np.unique(following):
                        more = b" ".join((*prefix, words[c - 1] if c else b""))
                        route[under[following == c]] = _route(key + more, routes)
                    total = np.full((depth, 1), -1)
                    total[:len(prefix), 0] = [place[w] for w in prefix]
                    if len(under):
                        rows = np.concatenate((rows, total), axis=1)
                        n = np.append(n, n[under].sum())
                        route = np.append(route, _route(key + b" ".join(prefix) + b"\x00", routes))
            order = np.argsort(route, kind="stable")
            rows, n, route = rows[:, order], n[order], route[order]
            cuts = np.flatnonzero(np.concatenate(([True], route[1:] != route[:-1], [True])))
            blocks = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                used, at = np.unique(rows[:, a:b], return_inverse=True)
                marks = int((used <= 0).sum())
                local = np.where(rows[:, a:b] > 0, at.reshape(depth, b - a) - marks + 1, rows[:, a:b])
                listed = [words[c - 1] for c in used[marks:]]
                blocks.append((int(route[a]), lang, listed, np.concatenate((local, n[None, a:b])).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in blocks], pa.int32()), pa.array([x[1] for x in blocks]),
                pa.array([x[2] for x in blocks], pa.list_(pa.binary())),
                pa.array([x[3].tobytes() for x in blocks], pa.binary())], names=["route", "lang", "words", "suffixes"])

    return map_batches(texts, run, "route int, lang string, words array<binary>, suffixes binary")


def multikey_quicksort(rows: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(depth, pointers, counts)`` of the prefixes, one pointer each, that at least ``least``
    of the weighted rows share.  All open partitions are split at once, each around the
    word of its middle pointer; the smaller and the larger part go on at the same word,
    the equal part at the next one, and parts below ``least`` are abandoned."""
    depth = rows.shape[0]
    at = np.arange(rows.shape[1])
    sizes = np.array([len(at)] if len(at) else [], np.int64)
    level = np.zeros(len(sizes), np.int64)
    while len(sizes):
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        part = np.repeat(np.arange(len(sizes)), sizes)
        value = rows[level[part], at]
        pivot = value[starts + sizes // 2]
        side = np.sign(value - pivot[part]) + 1
        child = 3 * part + side
        size = np.bincount(child, minlength=3 * len(sizes))
        total = np.bincount(child, weights[at], 3 * len(sizes)).astype(np.int64)
        down = np.tile([0, 1, 0], len(sizes))
        deeper = np.repeat(level, 3) + down
        keep = total >= least
        keep[1::3] &= pivot > 0  # a piece's end is no word
        place = np.concatenate(([0], np.cumsum(size)[:-1]))
        at = at[np.argsort(child, kind="stable")]
        for d in range(depth):
            found = np.flatnonzero(keep & (down == 1) & (deeper == d + 1))
            if len(found):
                yield d + 1, at[place[found]], total[found]
        keep &= deeper < depth
        at = at[np.repeat(keep, size)]
        sizes, level = size[keep], deeper[keep]


def frequent(texts: DataFrame, depth: int, least: int, routes: int, hot: dict[str, list[str]]) -> DataFrame:
    """``(lang, phrase, words, f)`` of all phrases of 1 to ``depth`` words that occur
    ``least`` times."""
    names = ["lang", "phrase", "words", "f"]

    def count(key: tuple, blocks: pa.Table) -> pa.Table:
        tables = []
        for lang in pc.unique(blocks["lang"]).to_pylist():
            part = blocks.filter(pc.equal(blocks["lang"], lang))
            listed = part["words"].combine_chunks()
            table = listed.flatten().dictionary_encode()
            codes = np.concatenate((table.indices.to_numpy() + 1, [0, 0]))
            lengths = pc.list_value_length(listed).to_numpy()
            rows, n = [], []
            for start, raw in zip(np.cumsum(lengths) - lengths, part["suffixes"]):
                block = np.frombuffer(raw.as_buffer(), np.int32).reshape(depth + 1, -1)
                rows.append(np.where(block[:-1] > 0, codes[np.maximum(block[:-1] + start - 1, 0)], block[:-1]).astype(np.int32))
                n.append(block[-1].astype(np.int64))
            rows, n = np.concatenate(rows, axis=1), np.concatenate(n)
            words = table.dictionary.to_pylist()
            totals = (rows < 0).any(axis=0)
            # rows of hot prefixes are their exact shares; the suffixes under them are in several routes
            prefixes = {tuple(p.encode("utf-8", "surrogatepass").split(b" ")) for p in hot.get(lang, ())}
            found: dict[tuple, int] = {}
            for j in np.flatnonzero(totals):
                phrase = tuple(words[c - 1] for c in rows[:, j] if c > 0)
                found[phrase] = found.get(phrase, 0) + int(n[j])
            rows, n = rows[:, ~totals], n[~totals]
            order = np.argsort(np.random.default_rng(0).random(len(n)))  # pivots at random
            rows, n = np.ascontiguousarray(rows[:, order]), n[order]
            result = [(p, f) for p, f in found.items() if f >= least]
            for d, at, f in multikey_quicksort(rows, n, least):
                for phrase, x in zip(zip(*(rows[k, at].tolist() for k in range(d))), f.tolist()):
                    phrase = tuple(words[c - 1] for c in phrase)
                    if phrase not in prefixes:
                        result.append((phrase, x))
            tables.append(pa.table([
                pa.array([lang] * len(result), pa.string()),
                pa.array([b" ".join(p).decode("utf-8", "surrogatepass") for p, _ in result], pa.string()),
                pa.array([len(p) for p, _ in result], pa.int32()), pa.array([f for _, f in result], pa.int64())], names=names))
        return pa.concat_tables(tables)

    session.ship(texts.sparkSession)
    blocks = routed(texts, depth, routes, hot)
    return blocks.groupBy("route").applyInArrow(count, "lang string, phrase string, words int, f long")


def score(a: str, l: str, r: str) -> Column:
    """floor(10^6 a² / (l r)) of columns of counts, exact."""
    return F.expr(f"cast((cast({a} as decimal(16,0)) * cast({a} as decimal(16,0)) * cast(1000000 as decimal(7,0)))"
                  f" div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0))) as long)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10,
                 share: int = 50, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of 2 to
    ``max_words`` words that occur ``least`` times, by the lowest score of their cuts.  A phrase
    goes where a longer one that contains it has ``share`` percent of its occurrences."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routes = max(LEAST_ROUTES, size // 4 // ROUTE_WORDS)
    share_of = min(2 * routes, MOST_HOT)
    prefixes = heavy_prefixes(texts, max_words, 2 * share_of)
    totals = prefixes.where(F.col("prefix").isNull()).select("lang", "n")
    words = totals.agg(F.sum("n")).first()[0] or 0
    hot: dict[str, list[str]] = {}
    for r in prefixes.where(F.col("prefix").isNotNull() & (F.col("n") * share_of >= words)).collect():  # share_of for each depth at most
        hot.setdefault(r["lang"], []).append(r["prefix"])
    known = written(frequent(texts, max_words, least, routes, hot), "phrases", few=False)
    found = known.where("words > 1").select("lang", "phrase", F.col("words").alias("_m"), F.col("f").alias("a"),
                                           F.split("phrase", " ").alias("_w"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("_m") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("_w", 1, F.col("k")), " ").alias("_left"),
                       F.array_join(F.slice("_w", F.col("k") + 1, F.col("_m") - F.col("k")), " ").alias("_right"))
    part = lambda name, f: known.select(F.col("lang"), F.col("phrase").alias(name), F.col("f").alias(f))
    scored = cuts.join(part("_left", "l"), ["lang", "_left"]).join(part("_right", "r"), ["lang", "_right"])
    lowest = scored.withColumn("score", score("a", "l", "r")).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k")).alias("b")).select("lang", "phrase", "b.*")
    inner = found.where("_m > 2").withColumn("_n", F.explode(F.sequence(F.lit(2), F.col("_m") - 1))) if max_words > 2 else None
    if inner is not None:
        inner = inner.withColumn("_at", F.explode(F.sequence(F.lit(1), F.col("_m") - F.col("_n") + 1))).select(
            "lang", F.array_join(F.slice("_w", F.col("_at"), F.col("_n")), " ").alias("phrase"), F.col("a").alias("_longer"))
        inner = inner.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
        lowest = lowest.join(inner, ["lang", "phrase"], "left").where(
            F.col("_longer").isNull() | (F.col("_longer") * 100 < F.lit(share) * F.col("a")))
    # the first rows of each deal of a language, then of the language: no task orders all of its phrases
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    deal = F.pmod(F.xxhash64("phrase"), F.lit(DEALS))
    best = lowest.withColumn("_deal", deal).withColumn("_n", F.row_number().over(
        Window.partitionBy("lang", "_deal").orderBy(*order))).where(F.col("_n") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
