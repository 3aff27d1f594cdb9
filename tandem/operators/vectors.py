"""Vector operators: pair inner products (F8, M5) and exact top-K
inner-product search between two vector tables (M16).

M16 never materialises all query x item pairs as rows. Items are cut into
classes of falling norm (``NormBlocks``) and classes into hash blocks; each
(query block, item block) cell is one cogroup task that multiplies the two
blocks with NumPy, a strip of queries at a time, and keeps a local top-K per query.
Every query first meets one block of the largest norms, which gives it a K-th score
to beat; after that it is sent only to classes whose largest norm times its own can
reach that score (Cauchy-Schwarz), only scores that reach it come back, and item
blocks that no query asks for are not sent at all. A final ``row_number() <= K`` per query merges the block results. Memory
per task is bounded by the block sizes, not by the table sizes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.expressions import dot
from tandem.operators.joins import bounded_broadcast
from tandem.operators.topk import min_rank_desc, top_score_per_user
from tandem.session import ship_package
from tandem.sources.io import materialise

TOPK_SCHEMA = "qid long, item_id long, score double"


def pair_dot(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
             out: str = "als_dot", rank_col: str | None = "als_rank") -> DataFrame:
    """M5: dot(user vector, item vector) per ``(uid, item_id)`` row, 0.0 when
    either side is unknown; optional min-rank (descending) per user (W2).

    Factors proven small are sent to the pairs: a pair then never carries a vector through an exchange."""
    uf = user_factors.select(F.col("id").alias("uid"), F.col("features").alias("_uf"))
    itf = item_factors.select(F.col("id").alias("item_id"), F.col("features").alias("_if"))
    out_df = (pairs.join(bounded_broadcast(uf), "uid", "left").join(bounded_broadcast(itf), "item_id", "left")
              .withColumn(out, F.coalesce(dot("_uf", "_if"), F.lit(0.0)))
              .drop("_uf", "_if"))
    if rank_col:
        out_df = min_rank_desc(out_df, "uid", out, rank_col)
    return out_df


STRIP = 1 << 20  # scores held at a time


def _block_topk(k: int):
    """The best ``k`` of a block for each query of another; with ``bar`` (null: none) only what reaches it."""
    def run(key, q: pd.DataFrame, it: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(it) == 0:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"),
                                 "item_id": pd.Series([], dtype="int64"),
                                 "score": pd.Series([], dtype="float64")})
        it = it.sort_values("_iid", kind="stable")
        qm = np.stack(q["_qf"].to_numpy())
        im = np.stack(it["_if"].to_numpy()).astype(np.float64)
        ids, qids = it["_iid"].to_numpy(dtype=np.int64), q["qid"].to_numpy(dtype=np.int64)
        bars = q["bar"].to_numpy(dtype=np.float64) if "bar" in q else np.full(len(q), np.nan)
        kk = min(k, len(ids))
        step = max(1, STRIP // len(ids))
        out = []
        for lo in range(0, len(q), step):
            scores = qm[lo:lo + step].astype(np.float64) @ im.T
            bar, open_ = bars[lo:lo + step].copy(), np.flatnonzero(np.isnan(bars[lo:lo + step]))
            # all scores down to the bar or the k-th of a query (a partition, no full sort),
            # then the few that are left in order, ties by the smaller id
            if len(open_):
                bar[open_] = np.partition(scores[open_], len(ids) - kk, axis=1)[:, len(ids) - kk]
            row, col = np.nonzero(scores >= bar[:, None])
            score = scores[row, col]
            order = np.lexsort((col, -score, row))
            row, col, score = row[order], col[order], score[order]
            first = np.searchsorted(row, row, side="left")
            keep = np.arange(len(row)) - first < kk
            out.append((qids[lo + row[keep]], ids[col[keep]], score[keep]))
        return pd.DataFrame(dict(zip(("qid", "item_id", "score"), (np.concatenate(x) for x in zip(*out, strict=True)), strict=True)))
    return run


NORM_CLASSES = 64
WIDER = 1 + 1e-9  # bounds are widened by more than rounding can take from them


def _norm(features) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


class NormBlocks:
    """Items in classes of falling norm, each cut by hash into blocks of about ``block_rows``.

    What the driver knows is one row a class (``NORM_CLASSES`` at most): its largest norm and its number of blocks.
    Equal norms share a class, whatever their number; only the hash cuts them."""

    def __init__(self, items: DataFrame, blocks: int, block_rows: int):
        normed = items.select(F.col("id").alias("_iid"), F.col("features").alias("_if"), _norm("features").alias("_norm"))
        classes = min(NORM_CLASSES, blocks)
        cuts = normed.agg(F.percentile_approx("_norm", [k / classes for k in range(1, classes)] or [0.5], 1000)).first()[0]
        cuts = sorted(set(cuts or []), reverse=True) if classes > 1 else []
        cls = F.lit(0)
        for c in cuts:
            cls = cls + (F.col("_norm") < F.lit(c)).cast("int")
        normed = normed.withColumn("_cls", cls)
        held = normed.groupBy("_cls").agg(F.max("_norm").alias("top"), F.count(F.lit(1)).alias("n")).orderBy("_cls").collect()
        self.classes = [(r["_cls"], r["top"], math.ceil(r["n"] / block_rows)) for r in held]
        subs = F.create_map(*[F.lit(v) for c, _, n in self.classes for v in (c, n)])
        self.items = normed.withColumn("_sub", F.pmod(F.xxhash64("_iid"), subs[F.col("_cls")]).cast("int")).drop("_norm")

    def first(self, queries: DataFrame) -> DataFrame:
        """Every query with the first block of the largest norms."""
        return queries.withColumn("_cls", F.lit(self.classes[0][0])).withColumn("_sub", F.lit(0))

    def others(self, queries: DataFrame) -> DataFrame:
        """Every query (with ``bar``, null: none) with all other blocks that may hold a score of at least its bar."""
        every = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(float(top)).alias("top"), F.lit(n).alias("n"))
                          for c, top, n in self.classes])
        can = F.filter(every, lambda x: F.col("bar").isNull() | (x["top"] * F.col("_qnorm") * F.lit(WIDER) >= F.col("bar")))
        asked = queries.withColumn("_c", F.explode(can)).withColumn("_sub", F.explode(F.sequence(F.lit(0), F.col("_c.n") - 1)))
        return (asked.withColumn("_cls", F.col("_c.c")).drop("_c")
                .where((F.col("_cls") != self.classes[0][0]) | (F.col("_sub") != 0)))


def topk_inner_product(queries: DataFrame, items: DataFrame, k: int,
                       query_block_rows: int = 8192, item_block_rows: int = 16384,
                       query_id: str = "id", cells: int | None = None) -> DataFrame:
    """For every query vector, the ``k`` items with the largest inner
    product (ties: smaller item id). ``k`` is clamped to the item count.
    Blocks have at most the given rows, and fewer if that makes ``cells``
    tasks (default: the cluster's parallelism); the side that is cut into
    fewer blocks is replicated less, so the smaller blocks go to the queries.

    ``queries``: (``query_id``, features); ``items``: (id, features).
    Returns (qid, item_id, score).
    """
    ship_package(queries.sparkSession)
    q = queries.select(F.col(query_id).alias("qid"), "features")
    nq, ni = q.count(), items.count()
    if nq == 0 or ni == 0:
        return q.sparkSession.createDataFrame([], TOPK_SCHEMA)
    cells = cells or q.sparkSession.sparkContext.defaultParallelism
    n_ib = max(1, math.ceil(ni / item_block_rows), min(2, ni // max(k, 64)))
    n_qb = max(1, math.ceil(nq / query_block_rows), min(math.ceil(cells / n_ib), math.ceil(nq / 64)))
    blocks = NormBlocks(items, n_ib, math.ceil(ni / n_ib))
    q = q.select("qid", F.col("features").alias("_qf"), F.pmod(F.xxhash64("qid"), F.lit(n_qb)).cast("int").alias("_qb"),
                 _norm("features").alias("_qnorm"))
    keys = ["_qb", "_cls", "_sub"]

    def searched(asked: DataFrame) -> DataFrame:
        # both sides must group on identically typed keys (int) or the cogroup
        # hashes them to different partitions
        wanted = asked.select(F.col("_qb").alias("_qb"), "_cls", "_sub").distinct()
        sent = blocks.items.join(wanted, ["_cls", "_sub"])
        bar = ["bar"] if "bar" in asked.columns else []
        return (asked.select("qid", "_qf", *bar, *keys).groupBy(*keys).cogroup(sent.groupBy(*keys))
                .applyInPandas(_block_topk(k), TOPK_SCHEMA))

    first = searched(blocks.first(q))
    if sum(n for _, _, n in blocks.classes) == 1:
        return first
    first = materialise(first)
    bars = first.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bar"))
    rest = searched(blocks.others(q.join(bars, "qid", "left")))
    return top_score_per_user(first.unionByName(rest), k, user="qid")
