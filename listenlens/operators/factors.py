"""Latent-factor models.

SVD (M2/M3): the top-``k`` right singular vectors of the user × item matrix by
a randomised range finder over long tables.  ``XᵀX V`` is two joins and two map-side
combined aggregations; orthonormalising needs the triangular factor of a tall and
narrow table, which a reduction tree of QR decompositions gives; only an l × l
triangle (l: at most twice ``k`` + oversampling) reaches the driver.  There is no
limit on users or items.

Implicit feedback (M4/M5): Spark ML ``ALS(implicitPrefs=True)`` replaces the
neural matrix-factorisation model; lists rank ``sigmoid(u · v)`` inside the
block product and drop heard items there.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.functions.columns import dot, sigmoid
from listenlens.functions.indexing import dense_index
from listenlens.operators import blockmat
from listenlens.session import ensure_checkpoint_dir, map_batches, materialize

U, S, P = "user_id", "song_id", "play_count"


def _weighted_sum(entries: DataFrame, vectors: DataFrame, on: str, key: str, width: int) -> DataFrame:
    """``(key, v)``: Σ value · vector over the entries of each key."""
    joined = entries.join(vectors, on)
    sums = joined.groupBy(key).agg(*(F.sum(F.col("_x") * F.col("v")[j]).alias(f"s{j}") for j in range(width)))
    return sums.select(key, F.array(*(f"s{j}" for j in range(width))).alias("v"))


def _stacked(rows: DataFrame, width: int, group) -> DataFrame:
    """The triangular factor of each group's rows of ``(g, r)``, one row per line."""
    schema = "g long, r array<double>"

    def qr(key: tuple, lines: pa.Table) -> pa.Table:
        r = np.linalg.qr(lines["r"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width), mode="r")
        return pa.table({"g": pa.array(np.full(len(r), key[0].as_py())), "r": pa.array(r.tolist(), pa.list_(pa.float64()))})

    return rows.withColumn("g", group).groupBy("g").applyInArrow(qr, schema)


def _triangle(vectors: DataFrame, width: int, fan_in: int = 64) -> np.ndarray:
    """R of a QR decomposition of the rows ``v``, reduced over a tree: every task keeps the
    triangle of its rows, ``fan_in`` triangles meet in one task, the last one reaches the
    driver (``width`` × ``width``).  Unlike VᵀV it does not square the condition."""
    schema = T.StructType([T.StructField("g", T.LongType()), T.StructField("r", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for batch in batches:
            m = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            held = np.linalg.qr(np.concatenate((held, m)), mode="r")
        g = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), g), pa.int64()),
                                          pa.array(held.tolist(), pa.list_(pa.float64()))], names=schema.names)

    tasks = vectors.select("v")
    triangles, n = map_batches(tasks, run, schema), tasks.rdd.getNumPartitions()
    while n > fan_in:
        triangles, n = _stacked(triangles, width, F.floor(F.col("g") / fan_in).cast("long")), -(-n // fan_in)
    lines = [r["r"] for r in triangles.select("r").collect()]  # fan_in triangles at most
    return np.linalg.qr(np.array(lines), mode="r") if lines else np.zeros((0, width))


def _orthonormal(vectors: DataFrame, key: str, width: int) -> tuple[DataFrame, int]:
    """An orthonormal basis of the columns and its width: directions below rounding
    noise fall away.  A division by R leaves errors of its condition, so it is repeated
    where that is large."""
    for _ in range(3):
        vectors = materialize(vectors)
        r = _triangle(vectors, width)
        _, size, turn = np.linalg.svd(r, full_matrices=False) if r.size else (0, np.zeros(0), np.zeros((0, width)))
        keep = size > size.max(initial=0.0) * 1e-13
        vectors, width = _rotated(vectors, key, turn[keep].T / size[keep]), int(keep.sum())
        if not width or size[width - 1] > 1e-4 * size[0]:
            break
    return vectors, width


def _beside(one: DataFrame, two: DataFrame, key: str) -> DataFrame:
    return one.join(two.withColumnRenamed("v", "_v"), key).select(key, F.concat("v", "_v").alias("v"))


def _rotated(vectors: DataFrame, key: str, m: np.ndarray) -> DataFrame:
    """Every row vector times the small matrix ``m``."""
    schema = T.StructType([vectors.schema[key], T.StructField("v", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) @ m
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.tolist(), pa.list_(pa.float64()))],
                                             names=schema.names)

    return map_batches(vectors.select(key, "v"), run, schema)


def svd_vectors(train: DataFrame, k: int = 20, oversample: int | None = None, rounds: int = 12,
                tolerance: float = 1e-5) -> tuple[DataFrame, DataFrame, list[float]]:
    """M2: ``(users, items, singular values)``: ``users`` holds ``X V`` (= U·S) and
    ``items`` the right singular vectors ``V``, as ``(id, v array<double>)``.

    A randomised range finder: a random block of ``k`` + ``oversample`` columns and its image
    under XᵀX span the search space (all of the row space, if it is no wider: then the
    first round is exact).  Other rounds cost five passes over the plays and end with the
    residuals |XᵀXv - s²v| / s₁² of the ``k`` vectors; while one is over ``tolerance`` the
    next round starts from the vectors found.  Unconverged vectors are never returned:
    after ``rounds`` rounds an ``ArithmeticError`` names the residual.  With
    ``k >= min(users, items)`` the truncated SVD reproduces the training matrix and ranks
    unseen items by rounding noise: a warning is raised.
    """
    rows = train.where(F.col(P) != 0).select(U, S, F.col(P).cast("double").alias("_x"))
    rows = materialize(rows)
    return singular_vectors(rows.select(S).distinct(), S, lambda v, width: _weighted_sum(rows, v, S, U, width),
                            lambda v, width: _weighted_sum(rows, v, U, S, width), k, oversample, rounds, tolerance)


Product = Callable[[DataFrame, int], DataFrame]


def singular_vectors(start: DataFrame, seed: str, forth: Product, back: Product, k: int, oversample: int | None = None,
                     rounds: int = 12, tolerance: float = 1e-5) -> tuple[DataFrame, DataFrame, list[float]]:
    """``svd_vectors`` of a matrix that is known by its products: ``forth`` gives ``X V`` by user for
    vectors ``(song_id, v)`` of a width, ``back`` gives ``XᵀV`` by item for vectors by user.  ``start``:
    the items, and the column ``seed`` that their random vectors hash."""
    width = k + (oversample if oversample is not None else 2 * k)
    draws = F.array(*(F.xxhash64(F.col(seed), F.lit(j)) / F.lit(float(1 << 63)) for j in range(width)))
    block = start.select(S, draws.alias("v"))
    error = np.inf
    for _ in range(rounds):
        image = back(forth(block, width), width)
        image, found = _orthonormal(image, S, width)
        if not found:
            return forth(block, width).limit(0), image, []
        # a narrower image is the whole row space
        whole = found < width
        basis, found = (image, found) if whole else _orthonormal(_beside(block, image, S), S, width + found)
        basis = materialize(basis)
        users = materialize(forth(basis, found))
        _, values, turn = np.linalg.svd(_triangle(users, found), full_matrices=False)
        turn, values = turn.T[:, :width], values[:width]
        items, users = materialize(_rotated(basis, S, turn)), materialize(_rotated(users, U, turn))
        kept = min(k, len(values))
        error = 0.0 if whole else _residual(back, users, items, values, kept)
        if error <= tolerance:
            break
        block, width = items, len(values)
    else:
        raise ArithmeticError(f"singular vectors not converged after {rounds} rounds: residual {error:.1e}, tolerance {tolerance:.1e}")
    if found <= k:
        warnings.warn(f"k={k} >= rank {found}: a full-rank SVD reproduces the training matrix", stacklevel=2)
    first = F.slice("v", 1, kept).alias("v")
    return users.select(U, first), items.select(S, first), values[:kept].tolist()


def _residual(back: Product, users: DataFrame, items: DataFrame, values: np.ndarray, k: int) -> float:
    """The largest |XᵀXv - s²v| / s₁² of the first ``k`` vectors."""
    image = back(users.select(U, F.slice("v", 1, k).alias("v")), k)
    both = items.join(image.withColumnRenamed("v", "_v"), S)
    squares = [F.sum(F.pow(F.col("_v")[j] - float(values[j]) ** 2 * F.col("v")[j], 2.0)).alias(f"e{j}") for j in range(k)]
    return float(np.sqrt(max(both.agg(*squares).first()))) / float(values[0]) ** 2


def svd_scores(train: DataFrame, pairs: DataFrame, k: int = 20) -> DataFrame:
    """M2: ``(user_id, song_id, score)`` of the rank-``k`` reconstruction for the
    given ``(user_id, song_id)`` pairs; unknown users and songs score 0."""
    users, items, _ = svd_vectors(train, k)
    known = pairs.select(U, S).join(users.withColumnRenamed("v", "_u"), U, "left").join(
        items.withColumnRenamed("v", "_i"), S, "left")
    return known.select(U, S, F.coalesce(dot(F.col("_u"), F.col("_i")), F.lit(0.0)).alias("score"))


def _long(vectors: DataFrame, key: str) -> DataFrame:
    return vectors.select(key, F.posexplode("v").alias("_f", "_x"))


def svd_recommend(train: DataFrame, items: DataFrame | None = None, k: int = 20,
                  top: int = 10) -> DataFrame:
    """Top unseen items by SVD score (scores, not held-out plays: B2)."""
    users, vectors, _ = svd_vectors(train, k)
    universe = (items if items is not None else train).select(S)
    return blockmat.top_k_product(_long(users, U), _long(vectors, S), universe, train.where(F.col(P) > 0).select(U, S),
                                  top, lr=U, lk="_f", lv="_x", rk="_f", rc=S, rv="_x", out_row=U, out_col=S)


def als_fit(interactions: DataFrame, rank: int = 8, max_iter: int = 10, reg: float = 0.1,
            alpha: float = 1.0, seed: int = 42):
    """M4: implicit ALS on ``(user_id, song_id, label)``; returns
    ``(model, user_index, item_index)``.  ALS checkpoints its factor lineage
    into the session's checkpoint folder every few iterations."""
    from pyspark.ml.recommendation import ALS
    ensure_checkpoint_dir(interactions.sparkSession)
    users = materialize(dense_index(interactions.select(U).distinct(), [U], name="_u"))
    items = materialize(dense_index(interactions.select(S).distinct(), [S], name="_i"))
    data = (interactions.join(users, U).join(items, S)
            .select(F.col("_u").cast("int").alias("_u"), F.col("_i").cast("int").alias("_i"),
                    F.col("label").cast("float").alias("_y")))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, implicitPrefs=True,
              userCol="_u", itemCol="_i", ratingCol="_y", seed=seed, coldStartStrategy="drop",
              nonnegative=False, checkpointInterval=5)
    return als.fit(data), users, items


def _als_vectors(model, users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (model.userFactors.join(users, F.col("id") == F.col("_u")).select(U, F.col("features").alias("v")),
            model.itemFactors.join(items, F.col("id") == F.col("_i")).select(S, F.col("features").alias("v")))


def als_scores(model, users: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    """M5: ``(user_id, song_id, score = sigmoid(u·v))`` of the given pairs with a
    known user and song (one user over its candidates is such a table)."""
    uf, itf = _als_vectors(model, users, items)
    return (pairs.select(U, S).join(uf.withColumnRenamed("v", "_a"), U).join(itf.withColumnRenamed("v", "_b"), S)
            .select(U, S, sigmoid(dot(F.col("_a").cast("array<double>"), F.col("_b").cast("array<double>"))).alias("score")))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def als_recommend(interactions: DataFrame, seen: DataFrame, top: int = 10,
                  candidates: DataFrame | None = None, **fit_kw) -> DataFrame:
    """Fit, score (optionally only ``candidates``), drop ``seen`` items, top-k per user."""
    model, users, items = als_fit(interactions, **fit_kw)
    uf, itf = _als_vectors(model, users, items)
    universe = items.select(S)
    if candidates is not None:
        universe = universe.join(candidates.select(S).distinct(), S, "left_semi")
    heard = seen.where(F.col(P) > 0).select(U, S)
    return blockmat.top_k_product(_long(uf, U), _long(itf, S), universe, heard, top, lr=U, lk="_f", lv="_x",
                                  rk="_f", rc=S, rv="_x", out_row=U, out_col=S, transform=_sigmoid)
