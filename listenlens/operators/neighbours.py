"""Nearest items of every item of the whole catalogue by cosine.

An exact similarity join over inverted lists (a list per user, an entry per item
with weight ``x = value / norm``), without a Gram matrix and without a row per pair:
lists travel packed, and the pairs of an item are made, added up and cut to its ``k``
best inside one task.

1. A list's ``k`` heaviest entries besides the item itself are partners with at least
   ``x`` times the list's ``k + 1``-th weight, so the largest of these products over an
   item's lists bounds its k-th best ``t`` from below.
2. Items are dealt into blocks and partners into parts.  Users' lists are written once, in
   packed bundles of whole lists; from these, for a few blocks at a time, a (block, part) task
   gets the lists' entries of its part, of the users that listen to its block.  An entry
   ``y`` is met by an item with weight ``x`` there, heaviest first, only if
   ``y >= slack * t * x``.  What an item misses of a partner is then below
   ``slack * t`` times the unmet part of its squared norm, and a partner whose sum and
   that bound stay below ``t`` is given up; a part's own k-th best sum raises ``t``.
3. The partners left of items that missed entries are multiplied out.  A part's ``k``
   best of every item are merged over the parts.

A task's memory is bounded by ``part_entries``, ``block_rows`` (a bundle; more only for one list
that has more) and ``BATCH``.  A list is copied once per block of those at work that its user
listens to, and once per part for the items' own entries, so the disk is bounded by a multiple
of the entries, however many blocks there are.  No partner
is dropped but by a bound.  Defined results: values must not be negative, zeros and null
users, items or values are left out; repeated (user, item) rows are added; an item with
fewer than ``k`` partners that share a user lists these; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlens.functions.indexing import dense_index
from listenlens.session import map_batches, release, shared_path

#: Similarities are ranked by this many digits.
DIGITS = 6
#: Pairs that a task makes at a time (more only for one item that has more).
BATCH = 4_000_000
#: Entries of a part; blocks for each part and blocks at least.
PART_ENTRIES, BLOCKS_PER_PART, LEAST_BLOCKS = 12_000_000, 2, 8
#: Entries of users' lists in a bundle; blocks whose lists are copied at a time.
BUNDLE, BLOCKS_AT_ONCE = 500_000, 4

#: Share of its lists' entries from which an item meets all of them.
MOSTLY = 0.75

_ASK, _LIST = 0, 1


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder."""
    path = shared_path(df.sparkSession, "neighbours")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _weights(rows: DataFrame, user: str, item: str, value: str) -> tuple[DataFrame, DataFrame]:
    """``(u, i, x)``: unit item vectors by the items' numbers; ``(i, item)``, numbered in item order."""
    entries = _written(rows.where((F.col(value) > 0) & F.col(user).isNotNull() & F.col(item).isNotNull())
                       .groupBy(F.col(user).alias("u"), F.col(item).alias("item")).agg(F.sum(F.col(value).cast("double")).alias("v")))
    norms = entries.groupBy("item").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    items = _written(dense_index(norms, ["item"], name="i"))
    weights = entries.join(items, "item").select("u", "i", (F.col("v") / F.col("norm")).alias("x"))
    return weights, items.select("i", "item")


def _bounds(weights: DataFrame, k: int) -> DataFrame:
    """``(i, t)``: a lower bound of the k-th best similarity, where a list has k partners."""
    heavy = Window.partitionBy("u").orderBy(F.desc("x"), "i")
    heads = (weights.withColumn("r", F.row_number().over(heavy)).where(F.col("r") <= k + 1).where(F.col("r") == k + 1)
             .select("u", F.col("x").alias("y")))
    # a place below the last ranked digit, so that ties by rounding stay in
    return (weights.join(heads, "u").groupBy("i").agg(F.max(F.col("x") * F.col("y")).alias("p"))
            .select("i", F.greatest(F.lit(0.0), F.col("p") - F.lit(2 * 10.0 ** -DIGITS)).alias("t")))


def _packed(values: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if len(values) else b"")


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


def _bundled(weights: DataFrame, bounds: DataFrame, block_rows: int) -> DataFrame:
    """``(g, u, i, x, t)``: a row for the whole lists of users with about ``block_rows`` entries; users are numbered
    within it.  Bounds lose digits downwards."""
    def one(rows: pa.Table, g: str) -> pa.RecordBatch:
        user = rows["u"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int32)
        on = (np.bincount(user) > 1)[user]  # one item alone has no partners
        low = np.nextafter(rows["t"].to_numpy()[on].astype(np.float32), np.float32(-1))
        packed = [_packed(np.diff(user[on], prepend=np.int32(0))), _packed(rows["i"].to_numpy()[on].astype(np.int32)),
                  _packed(rows["x"].to_numpy()[on]), _packed(np.maximum(low, np.float32(0)))]
        return pa.RecordBatch.from_arrays([pa.array([g]), *(pa.array([p], pa.binary()) for p in packed)], names=["g", "u", "i", "x", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, made = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= block_rows:
                rows = pa.Table.from_batches(held).combine_chunks()
                user = rows["u"].combine_chunks().dictionary_encode().indices.to_numpy()
                last = int(np.searchsorted(user, user[-1]))  # the last list may go on
                if last:
                    yield one(rows.slice(0, last), f"{TaskContext.get().partitionId()}-{made}")
                    made, held, n = made + 1, rows.slice(last).to_batches(), n - last
        if n:
            yield one(pa.Table.from_batches(held).combine_chunks(), f"{TaskContext.get().partitionId()}-{made}")

    entries = weights.join(bounds, "i", "left").select("u", "i", "x", F.coalesce("t", F.lit(0.0)).alias("t"))
    tasks = int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(entries.repartition(tasks, "u").sortWithinPartitions("u"), run, "g string, u binary, i binary, x binary, t binary")


def _copies(bundles: DataFrame, blocks: int, parts: int, first: int, last: int) -> DataFrame:
    """``(b, c, side, g, u, i, x, t)``: of every bundle the own entries of the blocks from ``first`` to before ``last``,
    and the entries of part ``c`` of the users that listen to block ``b``, in a row each."""
    names = ["b", "c", "side", "g", "u", "i", "x", "t"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 4]

    def dealt(g: str, u: np.ndarray, i: np.ndarray, x: np.ndarray, t: np.ndarray) -> Iterator[tuple]:
        def row(at: np.ndarray) -> list[bytes]:
            return [_packed(np.diff(u[at], prepend=np.int32(0))), _packed(i[at]), _packed(x[at])]

        block, part = i % blocks, i // blocks % parts
        of_block, of_part = (np.argsort(z, kind="stable") for z in (block, part))
        in_block, in_part = (np.searchsorted(z[o], np.arange(n + 1)) for z, o, n in ((block, of_block, blocks), (part, of_part, parts)))
        for b in range(first, last):
            own = of_block[in_block[b]:in_block[b + 1]]
            if not len(own):
                continue
            listens = np.zeros(int(u[-1]) + 1, bool)
            listens[u[own]] = True
            asks = (*row(own), _packed(t[own]))
            for c in range(parts):
                at = of_part[in_part[c]:in_part[c + 1]]
                at = at[listens[u[at]]]
                if len(at):
                    yield (b, c, _ASK, g, *asks)
                    yield (b, c, _LIST, g, *row(at), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                columns = [_unpacked(r[c], k) for c, k in (("u", np.int32), ("i", np.int32), ("x", np.float64), ("t", np.float32))]
                columns[0] = np.cumsum(columns[0], dtype=np.int32)
                rows = dealt(r["g"], *columns) if len(columns[0]) else iter(())
                while some := list(islice(rows, 64)):
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*some), kinds)], names=names)

    return map_batches(bundles, run, "b int, c int, side int, g string, u binary, i binary, x binary, t binary")


def _dealt(weights: DataFrame, bounds: DataFrame, blocks: int, parts: int, block_rows: int) -> DataFrame:
    """``_copies`` of all blocks."""
    return _copies(_bundled(weights, bounds, block_rows), blocks, parts, 0, blocks)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``starts[a], starts[a] + 1, ...`` (``counts[a]`` of them) of every ``a``."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _first_below(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
    """In every falling run ``values[lo:hi]`` the place of the first value under ``least``."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        middle = (lo + hi) // 2
        on = open_ & (values[np.minimum(middle, len(values) - 1)] >= least)
        lo, hi = np.where(on, middle + 1, lo), np.where(open_ & ~on, middle, hi)
    return lo


def _best(i: np.ndarray, j: np.ndarray, sim: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest ``sim`` of every ``i``, ties to the smaller ``j``."""
    order = np.lexsort((j, -sim, i))
    first = np.searchsorted(i[order], i[order])
    return order[np.arange(len(order)) - first < k]


def _multiplied(i_at: np.ndarray, j: np.ndarray, first: np.ndarray, last: np.ndarray, user: np.ndarray, x: np.ndarray,
                keys: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Whole sums of the pairs ``(i_at, j)``: ``keys`` are the sorted ``user * width + item`` of the lists."""
    out = np.zeros(len(j))
    sizes = last[i_at] - first[i_at]
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(BATCH, sizes.sum() + BATCH, BATCH), "right")
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(j)]):
        if a < b:
            own = np.repeat(np.arange(a, b), sizes[a:b])
            entry = _spread(first[i_at[a:b]], sizes[a:b])
            key = user[entry].astype(np.int64) * width + j[own]
            place = np.searchsorted(keys, key).clip(max=len(keys) - 1)
            hit = keys[place] == key
            out += np.bincount(own[hit], x[entry[hit]] * y[place[hit]], len(j))
    return out


def _nearest(asks: tuple, lists: tuple, k: int, slack: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(i, j, sim)``: the ``k`` best partners among ``lists`` of every item of ``asks``;
    ``asks``: user numbers, items, weights, bounds by entry; ``lists``: users, items, weights."""
    (au, ai, ax, at), (lu, lj, ly) = asks, lists
    order, sizes = np.lexsort((-ly, lu)), np.bincount(lu, minlength=int(au.max()) + 1)
    lj, ly = lj[order], ly[order]
    order = np.argsort(ai, kind="stable")
    au, ai, ax, at = au[order], ai[order], ax[order], at[order]
    del order, lu
    items, first = np.unique(ai, return_index=True)
    last = np.append(first[1:], len(ai))
    end = np.cumsum(sizes)[au]
    begin = end - sizes[au]
    met = _first_below(ly, begin, end, slack * at * ax) - begin
    # an item that would miss little meets all: cheaper than to multiply its partners out
    whole = np.add.reduceat(met, first) >= MOSTLY * np.add.reduceat(end - begin, first)
    met = np.where(np.repeat(whole, last - first), end - begin, met)
    del end
    width, by_key = int(max(lj.max(), ai.max())) + 1, None
    work = np.add.reduceat(met, first)
    a, so_far = 0, np.concatenate([[0], np.cumsum(work)])
    while a < len(items):
        b = max(a + 1, int(np.searchsorted(so_far, so_far[a] + BATCH, "right")) - 1)
        lo, hi = first[a], last[b - 1]
        place = _spread(begin[lo:hi], met[lo:hi])
        entry = np.repeat(np.arange(lo, hi), met[lo:hi])
        key = np.repeat(np.arange(b - a), work[a:b]) * width + lj[place]
        p, m = ax[entry] * ly[place], ax[entry] ** 2
        on = lj[place] != ai[entry]
        key, p, m = key[on], p[on], m[on]
        del place, entry, on
        if len(key):
            order = np.argsort(key)
            key = key[order]
            run = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, p, m = key[run], np.add.reduceat(p[order], run), np.add.reduceat(m[order], run)
            i, j = key // width + a, key % width
            least = at[first[i]]
            keep = p + slack * least * np.maximum(0.0, 1 - m) >= least - 1e-9
            i, j, p, m = i[keep], j[keep], p[keep], m[keep]
            part = ~whole[i]
            if part.any():
                # the k-th best sum of the part is a bound, too
                best = _best(i, j, p, k)
                counts = np.bincount(i[best] - a, minlength=b - a)
                kth = np.full(b - a, np.inf)
                np.minimum.at(kth, i[best] - a, p[best])
                bound = np.where(counts >= k, kth - 2 * 10.0 ** -DIGITS, 0.0)[i - a]
                keep = ~part | (p + slack * at[first[i]] * np.maximum(0.0, 1 - m) >= bound - 1e-9)
                i, j, p = i[keep], j[keep], p[keep]
                part = ~whole[i]
                if by_key is None:
                    keys = np.repeat(np.arange(len(sizes)), sizes) * width + lj
                    sort = np.argsort(keys)
                    by_key = keys[sort], ly[sort]
                    del keys, sort
                p[part] = _multiplied(i[part], j[part], first, last, au, ax, *by_key, width)
            sim = np.floor(p * 10.0 ** DIGITS + 0.5) / 10.0 ** DIGITS
            best = _best(i, j, sim, k)
            yield items[i[best]], j[best], sim[best]
        a = b


def _ranked(dealt: DataFrame, first: int, tasks: int, parts: int, k: int, slack: float) -> DataFrame:
    """``(i, j, sim)``: the ``k`` best of every part for every item of the blocks from ``first``."""
    names = ["i", "j", "sim"]

    def result(held: dict) -> Iterator[pa.RecordBatch]:
        starts, sides = {}, []
        if not held[_ASK] or not held[_LIST]:
            return
        users = 0
        for g, u, *_ in held[_ASK]:  # who listens to no item of the block asks for none
            starts[g], users = users, users + int(u[-1]) + 1
        for side in (_ASK, _LIST):
            columns = []
            for c in range(1, len(held[side][0])):
                columns.append(np.concatenate([r[1] + np.int32(starts[r[0]]) if c == 1 else r[c] for r in held[side]]))
                for r in held[side]:
                    r[c] = None
            sides.append(tuple(columns))
        sides[0] = (*sides[0][:3], sides[0][3].astype(np.float64))
        for found in _nearest(*sides, k, slack):
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {_ASK: [], _LIST: []}
        for batch in batches:
            for row in batch.to_pylist():
                if row["task"] != at:
                    yield from result(held)
                    at, held = row["task"], {_ASK: [], _LIST: []}
                columns = [np.cumsum(_unpacked(row["u"], np.int32), dtype=np.int32), _unpacked(row["i"], np.int32), _unpacked(row["x"], np.float64)]
                held[row["side"]].append([row["g"], *columns, *([_unpacked(row["t"], np.float32)] if row["side"] == _ASK else [])])
        yield from result(held)

    # a task's number is its partition
    placed = dealt.withColumn("task", (F.col("b") - first) * parts + F.col("c")).drop("b", "c").repartitionById(tasks, F.col("task"))
    return map_batches(placed.sortWithinPartitions("task"), run, "i long, j long, sim double")


def item_neighbours(rows: DataFrame, k: int = 10, user: str = "user_id", item: str = "song_id", value: str = "play_count",
                    slack: float = 0.25, block_rows: int = BUNDLE, part_entries: int = PART_ENTRIES) -> DataFrame:
    """``(item_i, item_j, sim, rank)``: the ``k`` best partners of every item, by
    similarity (rounded to 6 digits) and then by item."""
    weights, items = _weights(rows, user, item, value)
    weights = _written(weights)
    parts = max(1, -(-weights.count() // part_entries))
    blocks = max(LEAST_BLOCKS, BLOCKS_PER_PART * parts)
    bounds = _written(_bounds(weights, k))
    release(rows.sparkSession)
    bundles = _written(_bundled(weights, bounds, block_rows))
    best = Window.partitionBy("i").orderBy(F.desc("sim"), "j")
    found = []
    at_once = max(BLOCKS_AT_ONCE, LEAST_BLOCKS // parts)
    for first in range(0, blocks, at_once):
        # what the blocks before have shuffled may go
        release(rows.sparkSession)
        last = min(blocks, first + at_once)
        top = _ranked(_copies(bundles, blocks, parts, first, last), first, (last - first) * parts, parts, k, slack)
        found.append(_written(top.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)))
    top = reduce(DataFrame.unionByName, found)
    return (top.join(items.select("i", F.col("item").alias("item_i")), "i")
            .join(items.select(F.col("i").alias("j"), F.col("item").alias("item_j")), "j")
            .select("item_i", "item_j", "sim", "rank"))
