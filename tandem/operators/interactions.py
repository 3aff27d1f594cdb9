"""Interaction aggregates.

All are single hash aggregates with map-side partial aggregation, so a hot
item or user is pre-combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_counts(likes: DataFrame) -> DataFrame:
    """(uid, item_id, n) — the sparse user x item count matrix."""
    return likes.groupBy("uid", "item_id").agg(F.count(F.lit(1)).alias("n"))


def item_counts(likes: DataFrame, out: str = "n") -> DataFrame:
    """A1: likes per item."""
    return likes.groupBy("item_id").agg(F.count(F.lit(1)).alias(out))


def with_artist(likes: DataFrame, mapping: DataFrame, null_artist: int | None = None) -> DataFrame:
    """Likes x artist mapping (an item with several artists repeats).

    ``null_artist`` replaces a null artist id (the reference uses 0)."""
    m = mapping
    if null_artist is not None:
        m = m.select("item_id", F.coalesce("artist_id", F.lit(null_artist)).cast("long").alias("artist_id"))
    return likes.join(m, "item_id")


def artist_item_counts(likes: DataFrame, mapping: DataFrame) -> DataFrame:
    """A2: likes per (artist, item)."""
    return with_artist(likes, mapping).groupBy("artist_id", "item_id").agg(F.count(F.lit(1)).alias("n"))


def user_artist_counts(likes: DataFrame, mapping: DataFrame, null_artist: int | None = None) -> DataFrame:
    """A3: likes per (user, artist)."""
    return (with_artist(likes, mapping, null_artist)
            .groupBy("uid", "artist_id").agg(F.count(F.lit(1)).alias("n")))


def time_bounds(likes: DataFrame) -> DataFrame:
    """One row (min_ts, max_ts)."""
    return likes.agg(F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"))
