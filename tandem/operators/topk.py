"""Ranking, top-n and ordering operators.

Every ordering ends in an id so results do not depend on partitioning.
Top-n filters are written as ``row_number()/rank() <= n`` so Catalyst's
``InferWindowGroupLimit`` adds a partial group limit *before* the shuffle:
a user or artist holding a third of all rows still ships at most ``n`` rows
per map partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence, n: int,
                    rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group by ``order`` (``row_number``)."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*_order(order))
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def recent_per_user(df: DataFrame, n: int, user: str = "uid") -> DataFrame:
    """The ``n`` newest likes per user (ties: smaller item id first)."""
    return top_n_per_group(df, user, [F.desc("timestamp"), F.asc("item_id"), F.desc("is_organic")]
                           if "is_organic" in df.columns else [F.desc("timestamp"), F.asc("item_id")], n)


def top_score_per_user(df: DataFrame, n: int, user: str = "uid", score: str = "score",
                       item: str = "item_id", rank_col: str | None = None) -> DataFrame:
    """The ``n`` best-scored rows per user (ties: smaller item id first)."""
    return top_n_per_group(df, user, [F.desc(score), F.asc(item)], n, rank_col)


def min_rank_desc(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """``rank(method="min")`` of ``value`` descending within ``group``."""
    w = Window.partitionBy(group).orderBy(F.desc(value))
    return df.withColumn(out, F.rank().over(w))


def average_rank_filter(df: DataFrame, group: str, value: str, k: float,
                        out: str | None = None) -> DataFrame:
    """W1 + P8: keep rows whose *average* descending rank within ``group`` is <= k.

    Ties share the mean of the positions they occupy (9,7,7,5 -> 1,2.5,2.5,4),
    so a tie group straddling the limit is kept or dropped whole.

    average = (min rank + max rank) / 2. The min rank is ``rank()``; the max
    rank is ``count(*)`` over the default RANGE frame, which includes all
    peers. Because average >= min rank, ``rank() <= k`` is applied first; it
    gets a pre-shuffle group limit, and both windows share one partitioning.
    """
    w = Window.partitionBy(group).orderBy(F.desc(value))
    kept = df.withColumn("_rmin", F.rank().over(w)).where(F.col("_rmin") <= F.lit(k))
    ranked = (kept.withColumn("_rmax", F.count(F.lit(1)).over(w))
              .withColumn("_ravg", (F.col("_rmin") + F.col("_rmax")).cast("double") / 2.0)
              .where(F.col("_ravg") <= F.lit(float(k))))
    if out:
        ranked = ranked.withColumnRenamed("_ravg", out)
    else:
        ranked = ranked.drop("_ravg")
    return ranked.drop("_rmin", "_rmax")


def global_top_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """L1: global top-n (planned as TakeOrderedAndProject: local top-n per
    partition, then one bounded merge of n x partitions rows)."""
    return df.orderBy(*_order(order)).limit(n)


def latest_events(df: DataFrame, n: int) -> DataFrame:
    """L2: the ``n`` most recent events (returned in ascending time).

    Equal timestamps are broken by the remaining columns so the cut is
    deterministic; exact duplicate rows are interchangeable.
    """
    keys = [F.desc("timestamp")] + [F.desc(c) for c in df.columns if c != "timestamp"]
    return df.orderBy(*keys).limit(n).orderBy("timestamp", *[c for c in df.columns if c != "timestamp"])


def dedupe_max(df: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    """U4: one row per key with the largest score (deterministic ``unique``);
    other columns come from the best-scored row."""
    others = [c for c in df.columns if c not in keys and c != score]
    return df.groupBy(*keys).agg(F.max(score).alias(score), *[F.max_by(c, score).alias(c) for c in others])


def global_index(df: DataFrame, order: Sequence[str], index_col: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order``.

    Never an unpartitioned window: rows are range-partitioned on the order
    key, written once, numbered inside each range, and shifted by the row
    count of all lower ranges. Both the numbers and the counts read the
    written ranges: their bounds are sampled, and a second evaluation with
    other columns could sample others. The offset table has one row per range
    (bounded by the partition count), so it is broadcast.
    """
    from tandem.sources.io import materialise

    spark = df.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(df.repartitionByRange(n_parts, *order).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid").orderBy(*order)
    numbered = ranged.withColumn("_rn", F.row_number().over(w))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_off"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(index_col, (F.col("_off") + F.col("_rn") - 1).cast("long"))
            .drop("_pid", "_rn", "_off"))
