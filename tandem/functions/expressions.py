"""Scalar expressions (F1-F8) and hash-based sampling keys.

All of them are Catalyst expressions, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num, den) -> Column:
    """num / den as double, null when the denominator is 0 or null."""
    num, den = _col(num), _col(den)
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def row_sum(cols) -> Column:
    """row-wise sum that treats nulls as 0.0."""
    cols = [F.coalesce(_col(c).cast("double"), F.lit(0.0)) for c in cols]
    return reduce(lambda a, b: a + b, cols) if cols else F.lit(0.0)


def join_ids(ids_col) -> Column:
    """array of ids -> one space-separated string."""
    return F.array_join(F.transform(_col(ids_col), lambda x: x.cast("string")), " ")


def span_threshold(min_col, max_col, fraction: float) -> Column:
    """``min + int((max - min) * fraction)`` in long arithmetic."""
    mn, mx = _col(min_col), _col(max_col)
    return mn + F.floor((mx - mn).cast("double") * F.lit(float(fraction))).cast("long")


def dot(u, v) -> Column:
    """F8: inner product of two equal-length float arrays, in double."""
    prod = F.zip_with(_col(u), _col(v), lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def hash_key(seed: int, *cols) -> Column:
    """md5 of ``seed:c1:c2...`` as hex; independent of partitioning."""
    parts = [F.lit(str(seed))] + [_col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_unit(seed: int, *cols) -> Column:
    """Uniform number in [0, 1) from the first 8 hex digits of ``hash_key``."""
    return F.conv(F.substring(hash_key(seed, *cols), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
