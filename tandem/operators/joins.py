"""Join helpers.

``bounded_broadcast`` broadcasts a side only after proving its size, in rows and in bytes: one aggregation with a partial
result a task, so no rows meet in one place to be counted. Otherwise the side is returned unchanged and the join stays a
shuffle join, where AQE can still split skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 << 20
WORD = 8  # bytes of a fixed-size value, and of a variable one's place


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and about how many bytes they take in memory: a word a value, and what strings, binaries and arrays
    hold besides."""
    held = F.lit(WORD * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            held = held + F.coalesce(F.octet_length(F.col(f"`{f.name}`")).cast("long"), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            held = held + WORD * F.coalesce(F.size(F.col(f"`{f.name}`")).cast("long"), F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.sum(held)).first()
    return int(rows), int(total or 0)


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` provably has at most ``max_rows`` rows and about ``max_bytes`` bytes."""
    rows, held = size_of(df)
    return rows <= max_rows and held <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def attach_list(users: DataFrame, small: DataFrame, cols: list[str], key: str = "uid") -> DataFrame:
    """Pair every ``users`` row with every row of a small table of bounded size.

    ``small`` is folded into one array value by a scalar subquery (run once,
    shipped with the plan) and exploded per user, so the plan is a
    projection + generator instead of a cross join.
    """
    arr = small.select(F.collect_list(F.struct(*cols)).alias("_l")).scalar()
    return users.select(key, F.inline(arr))
