"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SCALE = 4294967296.0  # 2**32: first 8 hex digits of md5 as a fraction


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_key(*parts, seed: int = 42) -> Column:
    """``concat(p1, ':', p2, ..., ':', seed)`` — the input of every seeded draw."""
    pieces = []
    for p in parts:
        pieces += [col_of(p).cast("string"), F.lit(":")]
    pieces.append(F.lit(str(seed)))
    return F.concat(*pieces)


def md5_order(*parts, seed: int = 42) -> Column:
    """Deterministic random order: md5 hex of the seeded key.

    Recomputing a lost partition gives the same order, unlike ``rand()``.
    """
    return F.md5(seeded_key(*parts, seed=seed))


def md5_fraction(*parts, seed: int = 42) -> Column:
    """Uniform-looking number in [0, 1) from the seeded md5 (first 32 bits)."""
    hx = F.substring(md5_order(*parts, seed=seed), 1, 8)
    return F.conv(hx, 16, 10).cast("bigint") / F.lit(HASH_SCALE)


def holdout_size(n: Column, test_size: float = 0.2) -> Column:
    """``max(1, int(n * test_size))``."""
    return F.greatest(F.lit(1), F.floor(n.cast("double") * F.lit(float(test_size)))).cast("int")


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def as_double_array(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two numeric arrays, accumulated in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero (no division by zero)."""
    n = l2_norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)).otherwise(
        as_double_array(v))


def cosine(a: Column, b: Column) -> Column:
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb)).otherwise(F.lit(0.0))


def round6(c) -> Column:
    return F.round(col_of(c), 6)
