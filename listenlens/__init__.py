"""listenlens: music-listening analytics and recommendation on Spark DataFrames.

Sub-packages
------------
sources     readers for the play/track/genre/lyrics files and the star-schema adapter
functions   column expressions and small DataFrame helpers (hashing, vectors, indexing)
operators   charts, themes, interactions, similarity, recommendation, evaluation,
            classification, factor models and content vectors
plans       named queries (Spark) and their SQL oracles
"""

from listenlens.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
