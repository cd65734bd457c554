"""Distributed sparse × sparse products of long ``(row, col, value)`` tables.

``multiply`` gives the non-zero values of ``C[r, c] = Σ_k L[r, k] · R[k, c]``;
``top_k_product`` gives the ``k`` best columns of every row and never writes a
row × column table.

Layout (the replicated-block scheme of distributed matrix multiply): rows,
inner keys and output columns are hashed into buckets and blocks of bounded
size, every left entry is sent to each column block and every right entry to
each row bucket.  A task reads its blocks sorted, one inner block at a time, and
multiplies dense numpy blocks, so its memory is bounded by the block sizes and
not by the inner dimension, and a hot key is just more entries of a block.

Cost: the left side is copied once per column block and the right side once per
row bucket.  The workload's products have a core-sized item dimension
(``songs_limit``); a caller with a wide output pays one copy per 1,024 columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from listenlens.session import map_batches

DEFAULT_BLOCK = 1024
ROWS_PER_BUCKET = 4096
ROWS_PER_TASK = 2_000_000

_LEFT, _RIGHT, _COLUMN, _SEEN = 3, 2, 0, 1


def _blocks(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _count(df: DataFrame, *names: str) -> int:
    """Distinct keys; a scalar job that only sizes the blocks."""
    return df.select(*names).distinct().count()


def _segments(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """Runs of rows that share the first ``keys`` integer columns, whole even
    when they span batches."""
    held, at = [], None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns[:keys]:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(int(c[a]) for c in columns[:keys])
            if held and key != at:
                yield at, [np.concatenate(x) for x in zip(*held)]
                held = []
            held.append([c[a:b] for c in columns[keys:]])
            at = key
    if held:
        yield at, [np.concatenate(x) for x in zip(*held)]


def _dense(rows: np.ndarray, n_rows: int, cols: np.ndarray, n_cols: int, values: np.ndarray) -> np.ndarray:
    out = np.zeros((n_rows, n_cols))
    np.add.at(out, (rows, cols), values)
    return out


def _entries(df: DataFrame, side: int, rb: Column, cb: Column, kb: Column, k, r, c, v) -> DataFrame:
    """Rows ``(rb, cb, kb, side, k, r, c, v)`` of one operand."""
    return df.select(rb.alias("rb"), cb.alias("cb"), kb.alias("kb"), F.lit(side).alias("side"),
                     k.alias("k"), r.alias("r"), c.alias("c"), v.cast("double").alias("v"))


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _operands(left: DataFrame, right: DataFrame, lr, lk, lv, rk, rc, rv, n_rb: int, n_kb: int, n_cb: int) -> DataFrame:
    kt, rt, ct = left.schema[lk].dataType, left.schema[lr].dataType, right.schema[rc].dataType
    ls = left.select(F.col(lr).alias("_r"), F.col(lk).alias("_k"), F.col(lv).alias("_v"), _each(n_cb).alias("_cb"))
    rs = right.select(F.col(rk).cast(kt).alias("_k"), F.col(rc).alias("_c"), F.col(rv).alias("_v"), _each(n_rb).alias("_rb"))
    return _entries(ls, _LEFT, _blocks("_r", n_rb), F.col("_cb"), _blocks("_k", n_kb), F.col("_k"), F.col("_r"),
                    F.lit(None).cast(ct), F.col("_v")).unionByName(
        _entries(rs, _RIGHT, F.col("_rb"), _blocks("_c", n_cb), _blocks("_k", n_kb), F.col("_k"),
                 F.lit(None).cast(rt), F.col("_c"), F.col("_v")))


def _sorted_blocks(operands: DataFrame) -> DataFrame:
    return operands.repartition("rb", "cb").sortWithinPartitions("rb", "cb", "kb", "side")


def multiply(left: DataFrame, right: DataFrame, *, lr: str, lk: str, lv: str,
             rk: str, rc: str, rv: str, out_row: str | None = None, out_col: str | None = None,
             out_val: str = "value", block_size: int = DEFAULT_BLOCK,
             row_buckets: int | None = None) -> DataFrame:
    """``(out_row, out_col, out_val)``: the non-zero values of the product.

    Every (row bucket, inner block, column block) is a task of its own; partial
    products are summed with a map-side combined aggregation."""
    out_row, out_col = out_row or lr, out_col or rc
    n_left = left.count()
    n_kb = max(1, -(-_count(right, rk) // block_size))
    n_cb = max(1, -(-_count(right, rc) // block_size))
    n_rb = row_buckets or max(1, -(-n_left // (n_kb * ROWS_PER_TASK)))
    operands = _operands(left, right, lr, lk, lv, rk, rc, rv, n_rb, n_kb, n_cb)
    schema = T.StructType([T.StructField("r", left.schema[lr].dataType), T.StructField("c", right.schema[rc].dataType),
                           T.StructField("v", T.DoubleType())])
    types = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = right_block = None
        for (*block, side), (k, r, c, v) in _segments(batches, 4):
            if block != at:
                at, right_block = block, None
            if side == _RIGHT:
                keys, kpos = np.unique(k, return_inverse=True)
                cols, cpos = np.unique(c, return_inverse=True)
                right_block = keys, cols, _dense(kpos, len(keys), cpos, len(cols), v)
            elif right_block is not None:
                keys, cols, dense = right_block
                kpos = np.searchsorted(keys, k).clip(max=len(keys) - 1)
                on = keys[kpos] == k
                rows, rpos = np.unique(r[on], return_inverse=True)
                kpos, v = kpos[on], v[on]
                for a in range(0, len(rows), ROWS_PER_BUCKET):
                    b = min(a + ROWS_PER_BUCKET, len(rows))
                    own = (rpos >= a) & (rpos < b)
                    out = _dense(rpos[own] - a, b - a, kpos[own], len(keys), v[own]) @ dense
                    i, j = np.nonzero(out)
                    yield pa.RecordBatch.from_arrays([pa.array(rows[a + i], types[0]), pa.array(cols[j], types[1]),
                                                      pa.array(out[i, j])], names=schema.names)

    # without running sums over inner blocks these may be dealt apart
    dealt = operands.repartition("rb", "cb", "kb").sortWithinPartitions("rb", "cb", "kb", "side")
    return map_batches(dealt, run, schema).groupBy("r", "c").agg(F.sum("v").alias("v")).select(
        F.col("r").alias(out_row), F.col("c").alias(out_col), F.col("v").alias(out_val))


def gram(entries: DataFrame, *, row: str, col: str, val: str, block_size: int = DEFAULT_BLOCK,
         out_i: str = "item_i", out_j: str = "item_j", out_val: str = "dot") -> DataFrame:
    """``G[i, j] = Σ_r X[r, i] X[r, j]`` (= Xᵀ X) as long rows, non-zeros only."""
    return multiply(entries, entries, lr=col, lk=row, lv=val, rk=row, rc=col, rv=val,
                    out_row=out_i, out_col=out_j, out_val=out_val, block_size=block_size)


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` largest values of each row, best first; ties go
    to the smaller column, ``-inf`` is left out."""
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        r, c = np.nonzero((scores >= least) & (scores > -np.inf))
    else:
        r, c = np.nonzero(scores > -np.inf)
    order = np.lexsort((c, -scores[r, c], r))
    r, c = r[order], c[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    return r[place < k], c[place < k]


def top_k_product(left: DataFrame, right: DataFrame, columns: DataFrame, seen: DataFrame, k: int, *,
                  lr: str, lk: str, lv: str, rk: str, rc: str, rv: str, out_row: str | None = None,
                  out_col: str | None = None, out_val: str = "score",
                  transform: Callable[[np.ndarray], np.ndarray] | None = None,
                  block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``(out_row, out_col, out_val, rank)``: for every row of ``left`` the ``k``
    best of ``columns`` (a one-column table) that are not in ``seen`` (a two-column
    table: row, column).

    Columns that no entry reaches count with the value 0.  Values go through
    ``transform`` and are compared rounded to 6 digits, ties by column.  A (row
    bucket, column block) task adds up its inner blocks one by one and emits at
    most ``k`` rows per row; ``row_number() <= k`` merges the column blocks.
    """
    out_row, out_col = out_row or lr, out_col or rc
    columns = columns.select(F.col(columns.columns[0]).alias("_c")).distinct()
    n_rb = max(1, -(-_count(left, lr) // ROWS_PER_BUCKET))
    n_kb = max(1, -(-_count(right, rk) // block_size))
    n_cb = max(1, -(-columns.count() // block_size))
    kt, rt, ct = left.schema[lk].dataType, left.schema[lr].dataType, right.schema[rc].dataType
    none, before = lambda t: F.lit(None).cast(t), F.lit(-1)
    universe = columns.select("_c", _each(n_rb).alias("_rb"))
    heard = seen.toDF("_r", "_c").distinct()
    operands = _operands(left, right, lr, lk, lv, rk, rc, rv, n_rb, n_kb, n_cb).unionByName(
        _entries(universe, _COLUMN, F.col("_rb"), _blocks("_c", n_cb), before, none(kt), none(rt),
                 F.col("_c").cast(ct), F.lit(0.0))).unionByName(
        _entries(heard, _SEEN, _blocks("_r", n_rb), _blocks("_c", n_cb), before, none(kt), F.col("_r").cast(rt),
                 F.col("_c").cast(ct), F.lit(0.0)))
    schema = T.StructType([T.StructField("r", rt), T.StructField("c", ct), T.StructField("v", T.DoubleType())])
    types = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cols, hidden, rows, total, right_block = None, None, None, {}, None, None

        def result() -> Iterator[pa.RecordBatch]:
            if cols is None or not rows:
                return
            value = total[:len(rows)] if transform is None else transform(total[:len(rows)])
            ranked = np.round(value, 6)
            for a, c in hidden:
                if a in rows:
                    ranked[rows[a], c] = -np.inf
            i, j = best_columns(ranked, k)
            names = np.array(list(rows), dtype=object)
            yield pa.RecordBatch.from_arrays([pa.array(names[i], types[0]), pa.array(cols[j], types[1]),
                                              pa.array(value[i, j])], names=schema.names)

        for (rb, cb, kb, side), (key, r, c, v) in _segments(batches, 4):
            if (rb, cb) != at:
                yield from result()
                at, cols, hidden, rows, total, right_block = (rb, cb), None, [], {}, None, None
            if side == _COLUMN:
                cols, total = np.unique(c), np.zeros((ROWS_PER_BUCKET // 16, len(c)))
            elif cols is None:
                continue  # no column of the universe falls into this block
            elif side == _SEEN:
                place = np.searchsorted(cols, c).clip(max=len(cols) - 1)
                hidden = [(a, p) for a, p, same in zip(r, place, cols[place] == c) if same]
            elif side == _RIGHT:
                place = np.searchsorted(cols, c).clip(max=len(cols) - 1)
                on = cols[place] == c
                keys, kpos = np.unique(key[on], return_inverse=True)
                right_block = kb, keys, _dense(kpos, len(keys), place[on], len(cols), v[on])
            else:
                rpos = np.fromiter((rows.setdefault(a, len(rows)) for a in r), np.int64, len(r))
                while len(rows) > len(total):
                    total = np.concatenate([total, np.zeros_like(total)])
                if right_block is not None and right_block[0] == kb and len(right_block[1]):
                    _, keys, dense = right_block
                    kpos = np.searchsorted(keys, key).clip(max=len(keys) - 1)
                    on = keys[kpos] == key
                    own, rpos = np.unique(rpos[on], return_inverse=True)
                    total[own] += _dense(rpos, len(own), kpos[on], len(keys), v[on]) @ dense
        yield from result()

    local = map_batches(_sorted_blocks(operands), run, schema)
    best = Window.partitionBy("r").orderBy(F.desc(F.round("v", 6)), F.asc("c"))
    return (local.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)
            .select(F.col("r").alias(out_row), F.col("c").alias(out_col), F.col("v").alias(out_val), "rank"))
