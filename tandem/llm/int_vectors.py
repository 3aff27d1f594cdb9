"""Vectors of whole numbers: what the compression and the exact search have in common."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = (1 << 63) - 1


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
              carry: tuple = ()) -> DataFrame:
    """vec_id, q (array<long>, floor(scale * component)) and the columns of ``carry`` of all vectors that are not null
    and hold no null or non-finite component. A number beyond a long counts as the nearest long (but the least)."""
    v = F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    whole = lambda x: F.greatest(F.floor(F.lit(float(scale)) * x), F.lit(-MOST))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), *carry)
            .where(F.col("v").isNotNull() & ~F.coalesce(F.exists("v", bad), F.lit(True)))
            .select("vec_id", F.transform("v", whole).alias("q"), *carry))


def extent(ints: DataFrame) -> tuple[int, int]:
    """The longest vector's length and the largest size of a component (0, 0 without vectors)."""
    r = ints.agg(F.max(F.size("q")), F.max(F.array_max(F.transform("q", F.abs)))).first()
    return int(r[0] or 0), int(r[1] or 0)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column as rows of ``dim`` numbers; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    n = np.diff(column.offsets.to_numpy())
    if (n == dim).all():
        return flat.reshape(len(column), dim)
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim)[None, :] < n[:, None]] = flat
    return out
