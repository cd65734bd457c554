"""Evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U, S = "user_id", "song_id"


def precision_at_k(recs: DataFrame, test: DataFrame, k: int = 10,
                   name: str = "precision_at_k") -> DataFrame:
    """A10: mean over users with a non-empty test set of ``hits / k``.

    The divisor is always ``k`` (not the number recommended).  Users without
    recommendations count as 0 hits.  No test users → NULL.
    """
    test_items = test.select(U, S).distinct()
    hits = (recs.select(U, S).join(test_items, [U, S])  # J9/U2: intersection
            .groupBy(U).agg(F.count(F.lit(1)).alias("_hits")))
    per_user = (test_items.select(U).distinct().join(hits, U, "left")
                .select((F.coalesce(F.col("_hits"), F.lit(0)) / F.lit(float(k))).alias("_p")))
    return per_user.agg(F.avg("_p").alias(name))


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows where the prediction equals the label."""
    return predictions.agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))
