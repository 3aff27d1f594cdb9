"""Sampling and splitting.

Random choices are made by md5 of ``seed:key`` instead of ``sample()``, so
the same rows are chosen on any cluster and any partitioning. Only one-row
scalars (counts, time bounds, a split boundary) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.functions.expressions import hash_key, span_threshold
from tandem.operators.topk import global_index, recent_per_user
from tandem.sources.io import materialise

# Fixed values (reference notebook): span fractions of the two temporal
# splits, and the positional split points.
TEMPORAL_SPLITS = {1: (0.93, 0.98), 2: (0.75, 0.90)}
POSITIONAL_SPLITS = (0.60, 0.80)

_BUCKET_HEX = 4  # 16**4 = 65,536 hash buckets for exact selection


def hex_threshold(fraction: float) -> str:
    """8-hex-digit cut so that ``substr(md5, 1, 8) < cut`` keeps ``fraction``."""
    v = min(max(int(fraction * 4294967296.0), 0), 4294967295)
    return format(v, "08x")


def select_k_by_hash(keys: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """Exactly the ``k`` keys with the smallest ``md5(seed:key)`` (ties: key).

    Distributed exact selection: a 65,536-bucket histogram of the hash
    prefix (bounded size) locates the boundary bucket; everything below it is
    kept, and only the boundary bucket (~N/65,536 keys) is ranked.
    """
    h = keys.select(key, hash_key(seed, key).alias("_h"))
    h = h.withColumn("_b", F.conv(F.substring("_h", 1, _BUCKET_HEX), 16, 10).cast("int"))
    if k <= 0:
        return h.where(F.lit(False)).select(key)
    hist = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    wcum = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    boundary = (hist.withColumn("_cum", F.sum("_n").over(wcum))
                .where(F.col("_cum") >= k).orderBy("_b").limit(1)
                .select("_b", (F.lit(k) - (F.col("_cum") - F.col("_n"))).alias("_need")).first())
    if boundary is None:  # fewer than k keys: keep all
        return h.select(key)
    b, need = int(boundary["_b"]), int(boundary["_need"])
    below = h.where(F.col("_b") < b).select(key)
    wb = Window.partitionBy("_b").orderBy("_h", key)
    edge = (h.where(F.col("_b") == b).withColumn("_rn", F.row_number().over(wb))
            .where(F.col("_rn") <= need).select(key))
    return below.unionByName(edge)


def cap_history(likes: DataFrame, max_events_per_user: int = 3, target_rows: int | None = None,
                seed: int = 42) -> DataFrame:
    """R1 (+R2): newest ``max_events_per_user`` likes per user, then optionally
    keep whole users until about ``target_rows`` rows remain."""
    capped = recent_per_user(likes, max_events_per_user)
    if target_rows:
        capped = sample_users_to_rows(materialise(capped), target_rows, seed)
    return capped


def sample_users_to_rows(df: DataFrame, target_rows: int, seed: int = 42) -> DataFrame:
    """R2: fraction = target_rows / rows; keep ``int(fraction * users)`` whole users.

    ``df`` is read several times: give a written table. Its users are listed once."""
    rows = df.count()
    if rows <= target_rows:
        return df
    users = materialise(df.select("uid").distinct())
    n_users = users.count()
    k = int(target_rows / rows * n_users)
    chosen = select_k_by_hash(users, "uid", k, seed)
    return df.join(chosen, "uid", "left_semi")


def downsample_negatives(df: DataFrame, neg_fraction: float = 0.05, seed: int = 42,
                         keys=("uid", "item_id")) -> DataFrame:
    """All rows with target 1 plus ~``neg_fraction`` of the target-0 rows."""
    if neg_fraction >= 1:
        return df.where(F.col("target").isin(0, 1))
    cut = hex_threshold(neg_fraction)
    pick = F.substring(hash_key(seed, *keys), 1, 8) < F.lit(cut)
    return df.where((F.col("target") == 1) | ((F.col("target") == 0) & pick))


def temporal_thresholds(likes: DataFrame, size: int = 1) -> tuple[int, int]:
    """A9 + F6: (t1, t2) = min + int(span * l), min + int(span * r)."""
    lo, hi = TEMPORAL_SPLITS[size]
    row = (likes.agg(F.min("timestamp").alias("mn"), F.max("timestamp").alias("mx"))
           .select(span_threshold("mn", "mx", lo).alias("t1"), span_threshold("mn", "mx", hi).alias("t2"))
           .first())
    return int(row["t1"]), int(row["t2"])


def temporal_split(likes: DataFrame, size: int = 1):
    """(hist_train, train, val_hist, val) by span fraction.

    hist_train = ts < t1, train = t1 <= ts < t2, val_hist = ts < t2, val = ts >= t2.
    """
    t1, t2 = temporal_thresholds(likes, size)
    ts = F.col("timestamp")
    return (likes.where(ts < t1), likes.where((ts >= t1) & (ts < t2)),
            likes.where(ts < t2), likes.where(ts >= t2))


def positional_split(likes: DataFrame, fractions=POSITIONAL_SPLITS) -> DataFrame:
    """Label rows ``hist``/``train``/``val`` by position in time order
    (first 60 %, next 20 %, rest). Returns the frame with a ``part`` column."""
    order = ["timestamp", "uid", "item_id"] + [c for c in likes.columns
                                               if c not in ("timestamp", "uid", "item_id")]
    n = likes.count()
    s1, s2 = int(n * fractions[0]), int(n * fractions[1])
    idx = global_index(likes, order, "_idx")
    part = (F.when(F.col("_idx") < s1, "hist").when(F.col("_idx") < s2, "train").otherwise("val"))
    return idx.withColumn("part", part).drop("_idx")
