"""Vector operators: normalisation, exact cosine top-k, similar words
(S11, A15, V1, V2, T7, X11, X12).

``top_k_inner_product`` is an exact k-nearest-neighbour search by inner
product.  Queries are hashed into buckets and items into blocks; each
(bucket, block) task multiplies the two dense blocks with numpy and keeps only
its local top-k per query, so a task emits at most ``k`` rows per query.  A
final ``row_number() <= k`` per query merges the local lists.  No cross join,
no per-pair rows, and nothing goes through the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.functions.columns import l2_normalize as _unit
from listenlens.operators.blockmat import best_columns
from listenlens.session import materialize, ship

ITEMS_PER_BLOCK = 20_000
QUERIES_PER_BUCKET = 5_000


def l2_normalize(df: DataFrame, col: str = "vector", out: str | None = None) -> DataFrame:
    """Unit-length ``array<double>``; a zero vector stays zero."""
    return df.withColumn(out or col, _unit(F.col(col)))


def mean_vector(df: DataFrame, key: str, col: str = "vector", out: str = "vector") -> DataFrame:
    """A14 (dense): element-wise mean of the vectors of each key.

    Exploded by position and aggregated with partial (map-side) aggregation,
    so a key holding a large share of the rows is not gathered in one task.
    """
    exploded = df.select(key, F.posexplode(col).alias("_pos", "_x"))
    means = exploded.groupBy(key, "_pos").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    return (means.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("_pos", "_m"))).alias("_pm"))
            .select(key, F.transform("_pm", lambda s: s["_m"]).alias(out)))


def top_k_inner_product(queries: DataFrame, items: DataFrame, k: int, *,
                        query_id: str = "query_id", item_id: str = "item_id",
                        query_vec: str = "vector", item_vec: str = "vector",
                        exclude_self: bool = False, score: str = "score",
                        out_query: str | None = None, out_item: str | None = None,
                        write_inputs: bool = True) -> DataFrame:
    """``(query_id, item_id, score, rank)``: the ``k`` items with the largest
    inner product per query; scores are rounded to 6 digits and ties go to the
    smaller item id.  ``exclude_self`` drops ``item_id == query_id``.  Both sides
    are read by a count and by the search; ``write_inputs`` writes them once
    (false when they are plain tables already).
    """
    q = queries.select(F.col(query_id).alias("_q"), F.col(query_vec).alias("_qv"))
    it = items.select(F.col(item_id).alias("_i"), F.col(item_vec).alias("_iv"))
    if write_inputs:
        q, it = materialize(q), materialize(it)
    n_q, n_i = q.count(), it.count()
    # enough (bucket, block) tasks to keep every core busy, none too large
    slots = q.sparkSession.sparkContext.defaultParallelism
    n_qb = max(1, -(-n_q // QUERIES_PER_BUCKET), min(slots, n_q // 256))
    n_ib = max(1, -(-n_i // ITEMS_PER_BLOCK))
    qt = q.schema["_q"].dataType
    itype = it.schema["_i"].dataType

    qside = q.select(F.pmod(F.xxhash64("_q"), F.lit(n_qb)).cast("int").alias("qb"),
                     F.explode(F.sequence(F.lit(0), F.lit(n_ib - 1))).alias("ib"),
                     F.lit(0).alias("side"), F.col("_q"), F.lit(None).cast(itype).alias("_i"),
                     F.transform("_qv", lambda x: x.cast("double")).alias("_v"))
    iside = it.select(F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))).alias("qb"),
                      F.pmod(F.xxhash64("_i"), F.lit(n_ib)).cast("int").alias("ib"),
                      F.lit(1).alias("side"), F.lit(None).cast(qt).alias("_q"), F.col("_i"),
                      F.transform("_iv", lambda x: x.cast("double")).alias("_v"))

    schema = T.StructType([T.StructField("_q", qt), T.StructField("_i", itype),
                           T.StructField("_s", T.DoubleType())])

    def local_top_k(pdf: pd.DataFrame) -> pd.DataFrame:
        qs = pdf[pdf["side"] == 0]
        its = pdf[pdf["side"] == 1]
        if qs.empty or its.empty:
            return pd.DataFrame({"_q": pd.Series([], dtype=object), "_i": pd.Series([], dtype=object),
                                 "_s": pd.Series([], dtype="float64")})
        qm = np.stack(qs["_v"].to_numpy())
        im = np.stack(its["_v"].to_numpy())
        qids = qs["_q"].to_numpy()
        iids = its["_i"].to_numpy()
        order_ids = np.argsort(iids, kind="stable")  # ties: smaller item id first
        im, iids = im[order_ids], iids[order_ids]
        out = []
        for start in range(0, len(qids), 1024):
            sc = np.round(qm[start:start + 1024] @ im.T, 6)
            if exclude_self:
                own = qids[start:start + 1024]
                place = np.searchsorted(iids, own).clip(max=len(iids) - 1)
                at = np.flatnonzero(iids[place] == own)
                sc[at, place[at]] = -np.inf
            r, c = best_columns(sc, k)
            out.append(pd.DataFrame({"_q": qids[start + r], "_i": iids[c], "_s": sc[r, c]}))
        return pd.concat(out, ignore_index=True)

    ship(q.sparkSession)
    local = qside.unionByName(iside).groupBy("qb", "ib").applyInPandas(local_top_k, schema)
    w = Window.partitionBy("_q").orderBy(F.desc("_s"), F.asc("_i"))
    return (local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("long"))
            .select(F.col("_q").alias(out_query or query_id), F.col("_i").alias(out_item or item_id),
                    F.col("_s").alias(score), "rank"))


def cosine_top_k(queries: DataFrame, items: DataFrame, k: int = 10, **kw) -> DataFrame:
    """Exact nearest neighbours by inner product of unit vectors."""
    qv, iv = kw.pop("query_vec", "vector"), kw.pop("item_vec", "vector")
    return top_k_inner_product(l2_normalize(queries, qv), l2_normalize(items, iv), k,
                               query_vec=qv, item_vec=iv, **kw)


def similar_words(vectors: DataFrame, words: DataFrame | None = None, top_n: int = 10) -> DataFrame:
    """V2: ``(word, neighbor, similarity, rank)`` — the ``top_n`` most similar
    other words of each query word; a query word without a vector yields
    nothing (no error).  ``words`` (column ``word``) defaults to every word."""
    queries = vectors if words is None else vectors.join(words.select("word").distinct(), "word", "left_semi")
    return cosine_top_k(queries, vectors, top_n, query_id="word", item_id="word",
                        out_item="neighbor", exclude_self=True, score="similarity")
