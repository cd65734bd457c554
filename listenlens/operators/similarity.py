"""Item-item cosine similarity over play-count columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlens.operators import blockmat
from listenlens.session import materialize


def item_cosine(rows: DataFrame, user: str = "user_id", item: str = "song_id",
                value: str = "play_count", block_size: int = blockmat.DEFAULT_BLOCK) -> DataFrame:
    """``(item_i, item_j, sim)`` for every item pair with a common user.

    ``sim = Xᵢ·Xⱼ / (‖Xᵢ‖‖Xⱼ‖)`` over the user × item matrix ``X``.  Both
    directions and the diagonal are present; a zero-norm item has no row
    (its similarity is 0 everywhere, as in the dense definition).  The Gram
    matrix ``XᵀX`` comes from the block product, never from a self-join.
    """
    entries = rows.where(F.col(value) != 0).select(user, item, value)
    # the Gram matrix is read twice (diagonal, all entries): write it once
    g = materialize(blockmat.gram(entries, row=user, col=item, val=value, block_size=block_size))
    norms = (g.where(F.col("item_i") == F.col("item_j"))
             .select(F.col("item_i").alias("_item"), F.sqrt("dot").alias("_norm")))
    ni = norms.select(F.col("_item").alias("item_i"), F.col("_norm").alias("_ni"))
    nj = norms.select(F.col("_item").alias("item_j"), F.col("_norm").alias("_nj"))
    return (g.join(ni, "item_i").join(nj, "item_j")
            .select("item_i", "item_j", (F.col("dot") / (F.col("_ni") * F.col("_nj"))).alias("sim")))
