"""Consecutive indices without a global single-partition window.

``row_number() OVER (ORDER BY x)`` without PARTITION BY moves every row into
one task.  ``dense_index`` range-partitions the rows instead, numbers them
inside each range, and adds the row count of all earlier ranges (a table with
one row per partition, so it is bounded by the partition count, not the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlens.session import materialize


def _sort_exprs(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def dense_index(df: DataFrame, order, name: str = "idx", base: int = 0,
                num_partitions: int | None = None) -> DataFrame:
    """Number the rows of ``df`` consecutively from ``base`` in ``order``.

    ``order`` must be a total order over the rows of ``df`` (unique keys);
    then the result is deterministic and survives recomputation.
    """
    exprs = _sort_exprs(order)
    # one shuffle: rows are sorted inside their range and numbered there by the
    # row's place in its partition (the low 33 bits of the id); written once, so
    # the numbers and the ranges' sizes cannot differ
    ranged = df.repartitionByRange(num_partitions, *exprs) if num_partitions else df.repartitionByRange(*exprs)
    placed = materialize(ranged.sortWithinPartitions(*exprs).withColumn("_ll_at", F.monotonically_increasing_id()))
    placed = placed.select(*df.columns, F.shiftright("_ll_at", 33).alias("_ll_pid"),
                           F.col("_ll_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_ll_rn"))
    counts = placed.groupBy("_ll_pid").agg(F.count(F.lit(1)).alias("_ll_n"))
    # one row per partition: a global window here is bounded by the partition count
    offsets = counts.select(
        "_ll_pid",
        F.coalesce(F.sum("_ll_n").over(
            Window.orderBy("_ll_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_ll_off"))
    return (placed.join(offsets, "_ll_pid")
            .withColumn(name, (F.col("_ll_off") + F.col("_ll_rn") + F.lit(base)).cast("long"))
            .drop("_ll_pid", "_ll_rn", "_ll_off"))


def label_codes(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """``(col, code)`` — 0-based codes of the distinct values in sorted
    order (what a sorted label encoder assigns), computed with ``dense_index``."""
    return dense_index(df.select(col).distinct(), [col], name=name or f"{col}_code")
