from listenlens.functions.columns import (
    as_double_array, cosine, dot, holdout_size, l2_norm, l2_normalize, md5_fraction,
    md5_order, round6, seeded_key, sigmoid,
)
from listenlens.functions.indexing import dense_index, label_codes

__all__ = [
    "as_double_array", "label_codes", "cosine", "dense_index", "dot", "holdout_size",
    "l2_norm", "l2_normalize", "md5_fraction", "md5_order", "round6", "seeded_key", "sigmoid",
]
