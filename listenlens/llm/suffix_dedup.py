"""Removal of repeated byte strings by external induced sorting.

Every byte that a string of ``WINDOW`` bytes covers which also starts anywhere
else (in any document, or elsewhere in its own) is removed.  Strings are judged
on the input; they never cross documents.

1. Sample.  The suffixes that get sorted directly start at content-defined
   places: of each window the leftmost place whose ``GRAM``-byte hash is least.
   Equal windows have this place at the same distance from their start, so two
   equal windows always meet through equal sample suffixes.  Neighbouring
   windows share a place, about one byte in 85 is one.
2. Shards.  Sample places are dealt by their hash; only hashes that occur at
   two places or more go on, as the bytes that their windows can reach.  Spark's
   external sort orders each shard by hash and right context.
3. Induction.  The order of the suffixes one byte to the left follows from the
   order so far by one pass: each suffix enters the queue of its preceding byte
   in turn, and the queues are read in the order of their bytes.  The common
   prefix of two neighbours in a queue is one more than the least between them in
   the old order.  After d rounds a window d bytes left of its sample place is
   repeated exactly if its common prefix with a neighbour reaches ``WINDOW``.
   Queues are blocks of one array that lies on disk when a hash has more rows
   than ``MEMORY_ROWS``, so a shard may be far larger than memory.

The sample order comes from the external sort rather than from a further level
of induction: windows are bounded, so right contexts of ``WINDOW`` bytes settle it.

A hash that more than ``hot_rows`` places share (a passage of very many texts) is
not given to one task: its windows are counted by a 128-bit hash, combined on the
map side, and those that occur twice are joined back.  The bytes of a hash's windows
are compared as it is counted; a hash that stands for several is counted by bytes.

Texts are addressed by a 128-bit hash: copies of a text are sorted once, and a
text with copies is removed as a whole (if it has ``WINDOW`` bytes).

Defined results
---------------
* null text: empty; texts shorter than ``WINDOW`` bytes stay whole;
* null ids, equal ids, repeated rows: each row is a document, so repeated rows
  of ``WINDOW`` bytes or more lose all bytes; one result row per row;
* empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, py_texts, text_or_empty, written

WINDOW, GRAM = 200, 32  # GRAM
REACH = WINDOW - GRAM  # most bytes from a window's start to its sample place
CHUNK = 1 << 18  # bytes hashed at once
BLOCK = 1 << 22  # windows of one text handled at once
MEMORY_ROWS = 1 << 17
HOT_ROWS = 3 * MEMORY_ROWS
_POSITION = np.uint64((1 << 24) - 1)
_BYTE, _BYTE_2 = np.random.default_rng(20).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


def string_hashes(data: np.ndarray, length: int, table: np.ndarray = _BYTE, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from each position: polynomial hashes of
    1, 2, 4, ... bytes, put together by the binary digits of ``length``."""
    n = len(data) - length + 1
    x, step, power = table[data], 1, np.uint64(base)
    out, done = np.zeros(n, np.uint64), 0
    with np.errstate(over="ignore"):
        while step <= length:
            if length & step:
                out = out * power + x[done:done + n]
                done += step
            if 2 * step <= length:
                x = x[:-step] * power + x[step:]
            step, power = 2 * step, power * power
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def sample_places(data: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
    """``(place, hash, first window, last window)`` for the texts that lie at
    ``bounds`` of ``data`` (under 2^24 bytes)."""
    n = len(data) - WINDOW + 1
    valid = np.zeros(max(n, 0), bool)
    for a, b in bounds:
        valid[a:max(a, b - WINDOW + 1)] = True
    at = np.flatnonzero(valid)
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    hashes = string_hashes(data, GRAM)
    least, span, wide = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64), 1, REACH + 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    place = (np.minimum(least[:n], least[wide - span:wide - span + n]) & _POSITION)[at].astype(np.int64)
    new = np.flatnonzero((np.diff(at) != 1) | (np.diff(place) != 0)) + 1
    first, last = np.r_[0, new], np.r_[new, len(at)] - 1
    return place[first], hashes[place[first]], at[first], at[last]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _places_of(chunk: list[tuple[int, int, bytes, int]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows (h, ra, rb, packed) for pieces ``(ra, rb, bytes, offset in the text)``:
    sample places (packed >= 0: place, least and most distance of its windows),
    and stretches that repeat within a text (packed < 0: start, length)."""
    data = np.frombuffer(b"".join(c[2] for c in chunk), np.uint8)
    ends = np.cumsum([len(c[2]) for c in chunk])
    starts = ends - [len(c[2]) for c in chunk]
    place, h, first, last = sample_places(data, list(zip(starts.tolist(), ends.tolist())))
    of = np.searchsorted(starts, place, side="right") - 1
    keep, covers = np.ones(len(place), bool), {}
    order = np.lexsort((h, of))
    same = np.flatnonzero((of[order][1:] == of[order][:-1]) & (h[order][1:] == h[order][:-1]))
    if len(same):  # equal surroundings within one text: one of them stands for all
        seen: dict[tuple, int] = {}
        for i in np.unique(np.r_[order[same], order[same + 1]]).tolist():
            a, b = int(first[i]), int(last[i]) + WINDOW
            j = seen.setdefault((int(of[i]), int(place[i]) - a, data[a:b].tobytes()), i)
            if j != i:
                keep[i] = False
                covers.setdefault(int(of[i]), []).extend([(a, b), (int(first[j]), int(last[j]) + WINDOW)])
    ra, rb, base = (np.array([c[k] for c in chunk], np.int64) for k in (0, 1, 3))
    o = of[keep]
    packed = ((place - starts[of] + base[of]) << 16 | (place - last) << 8 | (place - first))[keep]
    yield h[keep].view(np.int64), ra[o], rb[o], packed
    rows = [(ra[d], rb[d], -1 - ((int(a - starts[d] + base[d])) << 31 | (b - a)))
            for d, spans in covers.items() for a, b in _merged(spans)]
    if rows:
        x, y, z = (np.array(c, np.int64) for c in zip(*rows))
        yield x, x, y, z


_PLACES = T.StructType([T.StructField(n, T.LongType()) for n in ("h", "ra", "rb", "packed")])


def _batch(schema: T.StructType, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)


def places(texts: DataFrame) -> DataFrame:
    """Rows of ``_PLACES`` for ``(ra, rb, text)``; a task handles a text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, chunk, size = set(), [], 0
        for batch in batches:
            for ra, rb, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (ra, rb) in done:
                    continue
                done.add((ra, rb))
                raw = text.as_py().encode()
                for at in range(0, max(1, len(raw) - WINDOW + 1), BLOCK):
                    piece = raw[at:at + BLOCK + WINDOW - 1]
                    if size and size + len(piece) > CHUNK:
                        yield from (_batch(_PLACES, *rows) for rows in _places_of(chunk))
                        chunk, size = [], 0
                    if len(piece) >= WINDOW:
                        chunk.append((ra, rb, piece, at))
                        size += len(piece)
        if chunk:
            yield from (_batch(_PLACES, *rows) for rows in _places_of(chunk))

    return map_batches(texts, run, _PLACES)


def repeated(rows: DataFrame) -> DataFrame:
    """The places whose hash occurs at two places or more, and all stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, matched = np.zeros((4, 0), np.int64), False
        for batch in batches:
            block = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            stretch = block[3] < 0
            if stretch.any():
                yield _batch(_PLACES, *block[:, stretch])
            block = np.concatenate([tail, block[:, ~stretch]], axis=1)
            if not block.shape[1]:
                continue
            block = block[:, np.r_[True, (block[:, 1:] != block[:, :-1]).any(axis=0)]]  # copies of a text
            same = block[0, 1:] == block[0, :-1]
            before = np.r_[matched, same]
            keep = before[:-1] | same
            yield _batch(_PLACES, *block[:, :-1][:, keep])
            tail, matched = block[:, -1:], bool(before[-1])
        if matched:
            yield _batch(_PLACES, *tail)

    return map_batches(rows.repartition("h").sortWithinPartitions("h", "ra", "rb", "packed"), run, _PLACES)


_CONTEXTS = T.StructType([T.StructField("h", T.LongType()), T.StructField("right", T.BinaryType()),
                          T.StructField("left", T.BinaryType()),
                          *(T.StructField(n, T.LongType()) for n in ("ra", "rb", "packed"))])


def contexts(texts: DataFrame) -> DataFrame:
    """The bytes that the windows of each place reach: ``right`` from the place
    on, ``left`` from it backwards.  ``texts``: (ra, rb, text, at: packed and h)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ra, rb, text, at in zip(*batch.columns):
                raw, rows = text.as_py().encode(), []
                for x in at.as_py():
                    p, least, most = x["packed"] >> 16, x["packed"] >> 8 & 255, x["packed"] & 255
                    rows.append((x["h"], raw[p:p + WINDOW - least], raw[p - most:p][::-1], ra.as_py(), rb.as_py(), x["packed"]))
                yield _batch(_CONTEXTS, *zip(*rows))

    return map_batches(texts, run, _CONTEXTS)


_WINDOWS = T.StructType([T.StructField(n, T.LongType()) for n in ("ra", "rb", "start", "w1", "w2")])
_WITH_BYTES = T.StructType([*_WINDOWS, T.StructField("bytes", T.BinaryType())])


def hot_windows(texts: DataFrame, with_bytes: bool = False) -> DataFrame:
    """``(ra, rb, start, w1, w2[, bytes])``: every window of the places in ``at`` with its
    128-bit hash."""
    schema = _WITH_BYTES if with_bytes else _WINDOWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ra, rb, text, at in zip(*batch.columns):
                raw = text.as_py().encode()
                for x in at.as_py():
                    p, least, most = x["packed"] >> 16, x["packed"] >> 8 & 255, x["packed"] & 255
                    data = np.frombuffer(raw[p - most:p - least + WINDOW], np.uint8)
                    w1, w2 = string_hashes(data, WINDOW), string_hashes(data, WINDOW, _BYTE_2, 0xC2B2AE3D27D4EB4F)
                    own = [[raw[s:s + WINDOW] for s in range(p - most, p - least + 1)]] if with_bytes else []
                    yield _batch(schema, np.full(len(w1), ra.as_py()), np.full(len(w1), rb.as_py()),
                                 np.arange(p - most, p - least + 1), w1.view(np.int64), w2.view(np.int64), *own)

    return map_batches(texts, run, schema)


def repeated_windows(places: DataFrame) -> DataFrame:
    """``(ra, rb, start)`` of the hot windows whose bytes stand at two places or more.  Windows
    are counted by hash; the least and the greatest bytes of a hash tell whether all are
    equal, and the windows of a hash that stands for several are counted by their bytes."""
    by_hash = written(hot_windows(places, True).groupBy("w1", "w2").agg(
        F.count("*").alias("n"), (F.min("bytes") == F.max("bytes")).alias("one")).where("n > 1"), "suffix-hot-windows")
    alike = hot_windows(places).join(by_hash.where("one").select("w1", "w2"), ["w1", "w2"]).select("ra", "rb", "start")
    mixed = by_hash.where("NOT one").select("w1", "w2")
    if mixed.isEmpty():
        return alike
    mixed = written(hot_windows(places, True).join(mixed, ["w1", "w2"]), "suffix-hot-mixed")
    several = mixed.groupBy("bytes").agg(F.count("*").alias("n")).where("n > 1").select("bytes")
    return alike.unionByName(mixed.join(several, "bytes").select("ra", "rb", "start"))


class Shard:
    """Rows of whole hashes in sorted order: bytes as one matrix, in memory or,
    beyond ``MEMORY_ROWS``, in a file."""

    def __init__(self, folder: str):
        self.folder, self.parts, self.meta, self.rows, self.file = folder, [], [], 0, None

    def add(self, right, left, meta: np.ndarray) -> None:
        table = np.zeros((len(right), WINDOW + REACH + 1), np.uint8)
        for i, (r, x) in enumerate(zip(right, left)):
            table[i, :len(r)] = np.frombuffer(r, np.uint8)
            table[i, WINDOW:WINDOW + len(x)] = np.frombuffer(x, np.uint8)
            table[i, -1] = len(r)
        self.meta.append(meta)
        self.rows += len(table)
        if self.rows > MEMORY_ROWS or self.file:
            self.file = self.file or open(os.path.join(self.folder, f"rows-{id(self)}"), "wb")
            for part in [*self.parts, table]:
                part.tofile(self.file)
            self.parts = []
        else:
            self.parts.append(table)

    def array(self, name: str, shape, dtype) -> np.ndarray:
        """Zeros, on disk if the rows are."""
        if not self.file:
            return np.zeros(shape, dtype)
        return np.memmap(os.path.join(self.folder, f"{name}-{id(self)}"), dtype, "w+", shape=shape)

    def matrix(self) -> np.ndarray:
        if not self.file:
            return np.concatenate(self.parts)
        self.file.close()
        return np.memmap(self.file.name, np.uint8, "r", shape=(self.rows, WINDOW + REACH + 1))


def _sorted_prefixes(table: np.ndarray, out: np.ndarray) -> None:
    """Common prefixes of neighbouring right contexts, into ``out[1:]``."""
    for a in range(1, len(table), 1 << 14):
        one, two = table[a - 1:a - 1 + (1 << 14)], table[a:a + (1 << 14)]
        one = one[:len(two)]
        differ = np.column_stack([one[:, :WINDOW] != two[:, :WINDOW], np.ones(len(two), bool)])
        out[a:a + len(two)] = np.minimum(np.minimum(differ.argmax(axis=1), one[:, -1]), two[:, -1])


def _least_between(values: np.ndarray, after: np.ndarray, to: np.ndarray) -> np.ndarray:
    """min(values[after + 1 .. to]) of each pair, by a sparse table."""
    levels, step = [values], 1
    longest = int((to - after).max(initial=1))
    while 2 * step <= longest:
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
        step *= 2
    level = np.frexp(to - after)[1] - 1  # floor of the base-2 logarithm
    out = np.zeros(len(to), values.dtype)
    for k, v in enumerate(levels):
        on = np.flatnonzero(level == k)
        out[on] = np.minimum(v[after[on] + 1], v[to[on] - (1 << k) + 1])
    return out


def induce(shard: Shard) -> np.ndarray:
    """Which windows repeat: a matrix (row, distance from window to place)."""
    table, packed = shard.matrix(), np.concatenate(shard.meta, axis=1)[3]
    fewest, most = packed >> 8 & 255, packed & 255
    marks = shard.array("marks", (shard.rows, REACH + 1), bool)
    order, prefix = shard.array("order-0", shard.rows, np.int64), shard.array("prefix-0", shard.rows, np.uint8)
    order[:] = np.arange(shard.rows)
    _sorted_prefixes(table, prefix)
    for d in range(REACH + 1):
        if d:
            order, prefix = _round(shard, d, order, prefix, table, most)
        if not len(order):
            break
        full = prefix >= WINDOW
        rows = order[full | np.r_[full[1:], False]]
        marks[rows[fewest[rows] <= d], d] = True
    return marks


def _round(shard: Shard, d: int, order, prefix, table, most) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes of the suffixes one byte further to the left."""
    blocks = range(0, len(order), MEMORY_ROWS)
    sizes = np.zeros(256, np.int64)
    for a in blocks:
        rows = order[a:a + MEMORY_ROWS]
        sizes += np.bincount(table[rows[most[rows] >= d], WINDOW + d - 1], minlength=256)
    head = np.cumsum(sizes) - sizes  # where each byte's queue goes on
    new_order = shard.array(f"order-{d % 2}-{d}", int(sizes.sum()), np.int64) if sizes.any() else np.zeros(0, np.int64)
    new_prefix = shard.array(f"prefix-{d % 2}-{d}", len(new_order), np.uint8) if sizes.any() else np.zeros(0, np.uint8)
    begun, floor = np.zeros(256, bool), np.full(256, 255, np.uint8)  # least prefix since a queue's last entry
    for a in blocks:
        rows, old = np.asarray(order[a:a + MEMORY_ROWS]), np.asarray(prefix[a:a + MEMORY_ROWS])
        on = np.flatnonzero(most[rows] >= d)
        byte = table[rows[on], WINDOW + d - 1]
        by = np.argsort(byte, kind="stable")
        at, byte = on[by], byte[by]  # queue after queue, each in the old order
        lead = np.r_[True, byte[1:] != byte[:-1]] if len(byte) else np.zeros(0, bool)
        after = np.r_[-1, at[:-1]][:len(at)]
        after[lead] = -1
        if len(at):
            between = _least_between(old, after, at)
            heads = byte[lead]
            between[lead] = np.where(begun[heads], np.minimum(between[lead], floor[heads]), 0)
            value = np.minimum(between.astype(np.int64) + 1, WINDOW)
            value[lead] *= begun[heads]
            counts = np.bincount(byte, minlength=256)
            to = head[byte] + np.arange(len(byte)) - np.repeat(np.flatnonzero(lead), counts[heads])
            new_order[to], new_prefix[to] = rows[at], value
            head += counts
        floor = np.minimum(floor, old.min(initial=255))
        if len(at):
            ends = at[np.r_[np.flatnonzero(lead)[1:], len(at)] - 1]
            tails = np.r_[np.minimum.accumulate(old[::-1])[::-1], 255]  # least from a place to the block's end
            floor[heads], begun[heads] = tails[ends + 1], True
    if shard.file and d > 1:  # the queues of the round before
        for name in ("order", "prefix"):
            os.unlink(os.path.join(shard.folder, f"{name}-{(d - 1) % 2}-{d - 1}-{id(shard)}"))
    return new_order, new_prefix


_STRETCH = T.StructType([T.StructField(n, T.LongType()) for n in ("ra", "rb", "start", "length")])


def stretches(sorted_contexts: DataFrame) -> DataFrame:
    """``(ra, rb, start, length)`` of repeated bytes, from sorted contexts."""

    def result(shard: Shard) -> Iterator[pa.RecordBatch]:
        marks, meta = induce(shard), np.concatenate(shard.meta, axis=1)
        for a in range(0, shard.rows, 1 << 14):
            edge = np.diff(np.pad(marks[a:a + (1 << 14)].astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, low = np.nonzero(edge == 1)
            high = np.nonzero(edge == -1)[1] - 1  # runs of distances, both in row order
            own = meta[:, a + row]
            if len(row):
                yield _batch(_STRETCH, own[1], own[2], (own[3] >> 16) - high, high - low + WINDOW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            shard, last = Shard(folder), None
            for batch in batches:
                h = batch.column(0).to_numpy(zero_copy_only=False)
                right, left = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                meta = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4, 5)])
                cuts = [0, *(np.flatnonzero(np.diff(h)) + 1).tolist(), len(h)]
                begin = 0
                for a, b in zip(cuts, cuts[1:]):  # hashes; several small ones share a shard
                    if a < b and last is not None and h[a] != last and shard.rows + a - begin >= MEMORY_ROWS // 4:
                        if a > begin:
                            shard.add(right[begin:a], left[begin:a], meta[:, begin:a])
                        yield from result(shard)
                        shard, begin = Shard(folder), a
                    last = h[b - 1] if b else last
                if begin < len(h):
                    shard.add(right[begin:], left[begin:], meta[:, begin:])
            if shard.rows:
                yield from result(shard)

    return map_batches(sorted_contexts, run, _STRETCH)


def _addressed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    own = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"))
    return own.withColumn("ra", F.xxhash64("text")).withColumn("rb", F.xxhash64(F.lit("second"), "text"))


def repeated_stretches(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(ra, rb, whole, parts)`` of the texts that lose bytes: whether all of
    them, else the stretches (start, length).  Hashes with over ``hot_rows`` places
    are not sorted in one task: their windows are counted by hash, proven by bytes,
    instead.  Up to there a hash of over ``MEMORY_ROWS`` places goes through queues on disk."""
    texts = _addressed(docs, id_column, text)
    by_text = written(texts.groupBy("ra", "rb").agg(F.count("*").alias("n"), F.min("id").alias("carrier")), "suffix-texts")
    found = written(repeated(places(texts.select("ra", "rb", "text"))), "suffix-places")
    hot = written(found.where("packed >= 0").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select("h"),
                  "suffix-hot")
    at_places = found.where("packed >= 0")

    def carried(rows: DataFrame, name: str) -> DataFrame:
        """The texts with their places in ``rows``, each text from one document."""
        at = rows.groupBy("ra", "rb").agg(F.collect_list(F.struct("packed", "h")).alias("at"))
        at = written(at.join(by_text, ["ra", "rb"]).select(F.col("ra").alias("_a"), F.col("rb").alias("_b"), "carrier", "at"), name)
        return texts.join(at, (F.col("ra") == F.col("_a")) & (F.col("rb") == F.col("_b"))
                          & F.col("id").eqNullSafe(F.col("carrier"))).select("ra", "rb", "text", "at")

    windows = repeated_windows(carried(at_places.join(hot, "h", "left_semi"), "suffix-hot-wanted"))
    of_hot = windows.withColumn("length", F.lit(WINDOW).cast("long"))
    own = found.where("packed < 0").select("ra", "rb", F.expr("shiftright(-1 - packed, 31)").alias("start"),
                                           F.expr("(-1 - packed) & 2147483647").alias("length"))
    shared = stretches(contexts(carried(at_places.join(hot, "h", "left_anti"), "suffix-wanted"))
                       .repartition("h").sortWithinPartitions("h", "right"))
    parts = shared.unionByName(own).unionByName(of_hot).groupBy("ra", "rb").agg(F.collect_set(F.struct("start", "length")).alias("parts"))
    return by_text.select("ra", "rb", (F.col("n") > 1).alias("whole")).join(parts, ["ra", "rb"], "left").where(
        "whole OR parts IS NOT NULL")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", with_kept: bool = False,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256[, kept])`` of every row;
    kept: the remaining bytes."""
    lost = written(repeated_stretches(docs, id_column, text, hot_rows), "suffix-lost")
    rows = _addressed(docs, id_column, text).join(lost, ["ra", "rb"], "left").select("id", "text", "whole", "parts")
    schema = T.StructType([rows.schema["id"]] + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept_sha256", T.StringType())] + [T.StructField("kept", T.BinaryType())] * with_kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, whole, parts in zip(py_texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                raw = text.encode()
                spans = [(0, len(raw))] if whole and len(raw) >= WINDOW else _merged(
                    [(p["start"], p["start"] + p["length"]) for p in parts or ()])
                edges = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(raw), len(raw) - len(kept), len(spans), sha256(kept).hexdigest()) + ((kept,) if with_kept else ()))
            columns = list(zip(*out)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [
                pa.array(c, pa.int64()) if i < 3 else pa.array(c, pa.string() if i == 3 else pa.binary())
                for i, c in enumerate(columns)], names=schema.names)

    return map_batches(rows, run, schema).withColumnRenamed("id", id_column)
