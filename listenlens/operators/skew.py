"""Joins whose key may be hot (S5, J1, J11): a word that every lyric holds, a song
that everyone plays.

A first pass names the heavy keys with Spark's frequent-items sketch (mergeable, of
bounded size); the join then deals the rows of each heavy key into slices and copies
the other side's rows of that key once per slice.  Keys that the sketch misses are
joined as usual, so the sketch decides about speed only, never about rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlens.session import materialize

#: Slices for each task of the join: small enough that slices of chance neighbours even out.
SLICES = 8
#: Heavy keys at most, and items that the sketch tracks: bounds of what is broadcast and of a task's sketch.
MOST_HEAVY, MOST_TRACKED = 65_536, 262_144
KINDS = ("inner", "left", "left_semi", "left_anti")


def heavy_keys(df: DataFrame, key: str, tasks: int) -> DataFrame:
    """``(key, _slices)`` of the keys that hold more than a slice's share of the rows,
    at most ``MOST_HEAVY`` of them; null is not among them.  Written, since both sides
    of a join read it."""
    share = SLICES * tasks
    tracked = min(4 * share, MOST_TRACKED)
    found = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {min(share, MOST_HEAVY, tracked)}, {tracked})").alias("top"),
        F.count(F.lit(1)).alias("n"))
    slices = F.ceil(F.col("x.count") * F.lit(share) / F.col("n")).cast("int")
    return materialize(found.select(F.explode("top").alias("x"), "n").select(
        F.col("x.item").alias(key), slices.alias("_slices")).where("_slices > 1"))


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", tasks: int | None = None,
               spread: list[str] | None = None) -> DataFrame:
    """``left.join(right, key, how)`` with the left's heavy keys dealt over tasks.

    ``how``: one of ``KINDS``, where a left row must meet every right row of its key
    once.  ``tasks``: of the join (default: the session's shuffle partitions).
    ``spread``: the left columns whose hash deals the rows (default: all but the key);
    a lost task deals its rows as before.  Right rows of a heavy key are copied per
    slice, so the right is meant to hold few rows of a key, as a dimension does.
    Null keys meet nothing; where ``how`` keeps their rows, those are dealt too."""
    if how not in KINDS:
        raise ValueError(f"how must be one of {KINDS}, not {how!r}")
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(left, key, tasks))  # MOST_HEAVY rows at most
    by = spread or [c for c in left.columns if c != key] or [key]
    slices = F.when(F.col(key).isNull(), F.lit(SLICES * tasks)).otherwise(F.coalesce("_slices", F.lit(1)))
    dealt = left.join(heavy, key, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(*by), slices.cast("long")).cast("int")).drop("_slices")
    copied = right.where(F.col(key).isNotNull()).join(heavy, key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))).drop("_slices")
    return dealt.join(copied, [key, "_slice"], how).drop("_slice")
