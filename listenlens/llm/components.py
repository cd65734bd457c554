"""Connected components of a large edge table with Spark joins.

Alternating large-star and small-star steps; every step's edges are written to
the shared folder, so rounds do not grow the lineage, both sides of each join
are plain tables (a hot centre is split by the skew join) and only two counts
per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlens.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges ``(u, v)``, ``u > v``.  Each node is linked to its
    smallest neighbour: large-star moves the larger neighbours there, small-star
    the smaller ones and the node itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = written(both.groupBy("u").agg(F.min("v").alias("_m"))
                    .select("u", F.least("u", "_m").alias("m")), "cc-min")
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return written(out.where(F.col("u") != F.col("v")).distinct(), "cc-edges")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; root: the smallest node of the
    component.  Null ends and loops are ignored; an empty table gives no rows."""
    now = written(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-edges")
    while True:
        nxt = _star(_star(now, large=True), large=False)
        same = nxt.count() == now.count() and nxt.join(now, ["u", "v"], "left_anti").isEmpty()
        now = nxt
        if same:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
