"""Pairwise-ranking factors over sampled negatives, trained block by block (D5 into M4).

Users and items are dealt into ``blocks`` blocks each.  A step of an epoch trains
``blocks`` strata at once, stratum ``(b, (b + step) mod blocks)`` of user and item
block: they share no user and no item, so the strata need no exchange, and after
``blocks`` steps every stratum was trained once.  A task holds the factors of its
two blocks and streams the stratum's triples ``(user, heard item, unheard item)``
in a fixed order; both items lie in the stratum's block.  Factors and triples are
written between steps: a lost executor repeats its own strata with the same result.

Defined results: plays that are not positive and null ids are left out, repeated
(user, item) rows count once; a heard item of a block which the user has heard
whole has no triple; an empty table gives empty factors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.functions import md5_fraction
from listenlens.functions.ranking import rank_within
from listenlens.operators import blockmat
from listenlens.session import map_batches, materialize, shared_path

U, S, P = "user_id", "song_id", "play_count"
USER, ITEM, TRIPLE = 0, 1, 2


def dealt(rows: DataFrame, column: str, blocks: int, seed: int = 42) -> DataFrame:
    """``(column, block, place)``: ids dealt to blocks by hash, numbered in them from 0."""
    ids = rows.select(column).distinct().select(column, F.pmod(F.xxhash64(F.lit(seed), column), F.lit(blocks)).cast("int").alias("block"))
    return rank_within(ids, "block", [column], "place").select(column, "block", (F.col("place") - 1).alias("place"))


def block_negatives(heard: DataFrame, items: DataFrame, draw: int = 0, seed: int = 42) -> DataFrame:
    """``(user_id, place, other)``: for each heard item an unheard one of the same
    block, uniform and exact without retries (see ``interactions.negative_samples``).
    ``heard``: ``(user_id, song_id, block, place)``."""
    sizes = items.groupBy("block").agg(F.count("place").alias("size"))
    own = heard.select(F.concat_ws("\t", F.col("block").cast("string"), U).alias("g"), U, S, "block", "place")
    n = own.groupBy("g").agg(F.count("place").alias("n"))
    gaps = rank_within(own, "g", ["place"], "p").select(
        "g", U, "block", (F.col("place") - F.col("p") + 1).alias("key"), F.lit(0).alias("kind"), "place", F.lit(0).cast("long").alias("d"))
    drawn = own.join(n, "g").join(sizes, "block").where(F.col("size") > F.col("n")).select(
        "g", U, "block", F.floor(md5_fraction(U, S, F.lit(f"draw{draw}"), seed=seed) * (F.col("size") - F.col("n"))).alias("key"),
        F.lit(1).alias("kind"), "place")
    drawn = rank_within(drawn, "g", ["key", "place"], "d")
    return (rank_within(gaps.unionByName(drawn), "g", ["key", "kind", "place"], "r").where(F.col("kind") == 1)
            .select(U, "block", "place", (F.col("key") + F.col("r") - F.col("d")).alias("other")))


def triples(rows: DataFrame, users: DataFrame, items: DataFrame, draws: int, blocks: int, seed: int = 42) -> DataFrame:
    """``(draw, step, key, u, i, j, o)``: places of the user and the two items, stratum and order."""
    heard = materialize(rows.join(items, S))
    own = users.select(U, F.col("block").alias("key"), F.col("place").alias("u"))
    parts = [block_negatives(heard, items, d, seed).withColumn("draw", F.lit(d)) for d in range(draws)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.join(own, U).select(
        "draw", F.pmod(F.col("block") - F.col("key"), F.lit(blocks)).alias("step"), "key", "u", F.col("place").alias("i"),
        F.col("other").alias("j"), F.xxhash64(F.lit(seed), "draw", U, "place").alias("o"))


def first_factors(ids: DataFrame, column: str, rank: int, seed: int = 42) -> DataFrame:
    """Small seeded factors: uniform in ±0.5 / sqrt(rank)."""
    draws = [(md5_fraction(F.col(column), F.lit(f"f{f}"), seed=seed) - 0.5) / F.lit(float(np.sqrt(rank))) for f in range(rank)]
    return ids.select("block", "place", F.array(*draws).alias("v"))


def gradient_step(users: np.ndarray, items: np.ndarray, u: np.ndarray, i: np.ndarray, j: np.ndarray, rate: float, reg: float) -> None:
    """One ascent step of log sigmoid(p_u · (q_i - q_j)) - reg |.|² / 2, in place; a
    row that occurs several times takes the mean of its gradients."""
    p, a, b = users[u], items[i], items[j]
    g = (1 / (1 + np.exp(np.einsum("nf,nf->n", p, a - b))))[:, None]
    for table, at, up in ((users, u, g * (a - b) - reg * p), (items, np.r_[i, j], np.r_[g * p - reg * a, -g * p - reg * b])):
        rows, place, count = np.unique(at, return_inverse=True, return_counts=True)
        total = np.zeros((len(rows), table.shape[1]))
        np.add.at(total, place, up)
        table[rows] += rate * total / count[:, None]


class _Stratum:
    """Factors of two blocks and the triples not yet used."""

    def __init__(self, key: int, rate: float, reg: float, batch: int):
        self.key, self.rate, self.reg, self.batch = key, rate, reg, batch
        self.held: tuple[list, list] = ([], [])
        self.tables: list[np.ndarray] | None = None
        self.left = np.zeros((0, 3), np.int64)

    def add(self, kind: int, places: np.ndarray, values: np.ndarray) -> None:
        self.held[kind].append((places, values))

    def _matrix(self, kind: int) -> np.ndarray:  # rows come sorted by place, from 0 without a gap
        return np.concatenate([v for _, v in self.held[kind]]) if self.held[kind] else np.zeros((0, 0))

    def train(self, three: np.ndarray, last: bool = False) -> None:
        if self.tables is None:
            self.tables = [self._matrix(USER), self._matrix(ITEM)]
        self.left = np.concatenate([self.left, three])
        while len(self.left) >= (1 if last else self.batch):
            now, self.left = self.left[:self.batch], self.left[self.batch:]
            gradient_step(self.tables[USER], self.tables[ITEM], now[:, 0], now[:, 1], now[:, 2], self.rate, self.reg)

    def out(self) -> Iterator[tuple[int, np.ndarray]]:
        self.train(np.zeros((0, 3), np.int64), last=True)
        yield from ((kind, self.tables[kind]) for kind in (USER, ITEM) if len(self.tables[kind]))


_SCHEMA = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("key", T.IntegerType()),
                        T.StructField("place", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType()))])


def _step(users: DataFrame, items: DataFrame, three: DataFrame, step: int, blocks: int, rate: float, reg: float, batch: int):
    none, zero = F.lit(None).cast("array<double>"), F.lit(0).cast("long")

    def side(table, kind, key):
        return table.select(F.lit(kind).alias("kind"), key.cast("int").alias("key"), "place", zero.alias("i"), zero.alias("j"), "v", zero.alias("o"))

    rows = side(users, USER, F.col("block")).unionByName(side(items, ITEM, F.pmod(F.col("block") - F.lit(step), F.lit(blocks)))).unionByName(
        three.select(F.lit(TRIPLE).alias("kind"), F.col("key").cast("int"), F.col("u").alias("place"), "i", "j", none.alias("v"), "o"))
    rows = rows.repartition(blocks, "key").sortWithinPartitions("key", "kind", "o", "place", "i", "j").drop("o")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Stratum | None = None

        def done(s):
            for kind, table in s.out():
                for a in range(0, len(table), 4096):
                    part = table[a:a + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), kind), pa.int32()), pa.array(np.full(len(part), s.key), pa.int32()),
                         pa.array(np.arange(a, a + len(part)), pa.int64()), pa.array(list(part), pa.list_(pa.float64()))],
                        names=_SCHEMA.names)

        for batch_ in batches:
            kind, key, u, i, j = (batch_.column(c).to_numpy(zero_copy_only=False) for c in range(5))
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(key)].tolist()):
                if a == b:
                    continue
                if now is None or now.key != key[a]:
                    if now is not None:
                        yield from done(now)
                    now = _Stratum(int(key[a]), rate, reg, batch)
                if kind[a] == TRIPLE:
                    now.train(np.stack([u[a:b], i[a:b], j[a:b]], axis=1))
                else:
                    values = batch_.column(5).slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
                    now.add(int(kind[a]), u[a:b], values.reshape(b - a, -1).copy())
        if now is not None:
            yield from done(now)

    out = materialize(map_batches(rows, run, _SCHEMA))
    of_item = F.pmod(F.col("key") + F.lit(step), F.lit(blocks))
    return (out.where(F.col("kind") == USER).select(F.col("key").alias("block"), "place", "v"),
            out.where(F.col("kind") == ITEM).select(of_item.alias("block"), "place", "v"))


def fit(plays: DataFrame, rank: int = 8, epochs: int = 8, blocks: int = 8, draws: int = 2, rate: float = 0.3,
        reg: float = 0.01, batch: int = 256, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``(users, items)``: ``(id, v)`` factors.  ``blocks`` bounds the factors that a task
    holds (users / blocks and items / blocks rows) and is the number of tasks of a step."""
    rows = materialize(plays.where((F.col(P) > 0) & F.col(U).isNotNull() & F.col(S).isNotNull()).select(U, S).distinct())
    users, items = materialize(dealt(rows, U, blocks, seed)), materialize(dealt(rows, S, blocks, seed))
    path = shared_path(rows.sparkSession, "ranking-triples")
    triples(rows, users, items, draws, blocks, seed).write.partitionBy("draw", "step").parquet(path)
    three = rows.sparkSession.read.schema("key int, u long, i long, j long, o long, draw int, step int").parquet(path)
    p, q = first_factors(users, U, rank, seed), first_factors(items, S, rank, seed)
    for epoch in range(epochs):
        for step in range(blocks):
            own = three.where((F.col("draw") == epoch % draws) & (F.col("step") == step))
            p, q = _step(p, q, own, step, blocks, rate, reg, batch)
    return users.join(p, ["block", "place"]).select(U, "v"), items.join(q, ["block", "place"]).select(S, "v")


def recommend(users: DataFrame, items: DataFrame, plays: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` unheard items of every user by inner product."""
    long = [t.select(key, F.posexplode("v").alias("_f", "_x")) for t, key in ((users, U), (items, S))]
    return blockmat.top_k_product(*long, items.select(S), plays.where(F.col(P) > 0).select(U, S), top,
                                  lr=U, lk="_f", lv="_x", rk="_f", rc=S, rv="_x", out_row=U, out_col=S)
