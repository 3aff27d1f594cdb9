"""Exact largest inner products by best-first search of M-trees.

Inner products become distances: with the largest norm M of the table, x is lifted to (x, sqrt(M^2 - |x|^2)) and a
query to (q, 0), so that d(q, x)^2 = |q|^2 + M^2 - 2 q.x, in a metric space where the nearest is the best.

Layout. Equal vectors are one object with its k + 1 smallest ids (no answer can hold more). Objects go to the nearest of
``PIVOTS`` objects picked by hash, and a pivot's objects are cut by hash into shards of about ``SHARD_ROWS``. A shard is
one M-tree, built in one task: pages of routing objects with covering radius and distance to the parent object, leaf
pages of objects with their distance to the leaf's routing object.

Search. A query keeps its pages in a heap by the best score that their radius allows. On a page the stored distances to
the parent rule out entries by the triangle inequality before anything is computed; the others cost one inner product
each. It ends when the best page allows less than the last answer. Every query first searches a shard of its nearest
pivot; the bar found there and the pivots' radii decide which other shards it is sent to. All bounds are widened by a
millionth of |q|^2 + M^2, far beyond what rounding can do to them, and scores themselves are whole numbers, so the
result is exact. A (shard, query block) pair is a task, and only its answers leave it.

Cases. Null vectors, vectors with null or non-finite components and rows without an id take no part. A shorter vector
counts as padded with zeros, so a zero or empty one scores 0. Equal rows count once. Of different vectors under one id
each is a candidate, and a query of its own; none is a candidate of a query with its id. Ties go to the smaller id. Fewer
candidates than k give fewer rows. Where sums may pass 2^53 they are made with Python's integers; a score beyond a long
counts as the nearest long, and ties there.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.llm.common import prepare, written
from tandem.llm.int_vectors import MOST, extent, matrix, quantised

K = 5
EVERY = 50
PAGE = 256
FANOUT = 16
PIVOTS = 16
SHARD_ROWS = 8192
QUERY_BLOCK = 2048
SLACK = 1e-6


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))[:, None]], axis=1)


def _far(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - c) ** 2).sum(axis=-1))


class Tree:
    """An M-tree over rows of whole numbers. ``order`` is the order of its leaves; pages are numbered parents first.

    Of page p: ``centre[p]`` its routing object's row, ``radius[p]``, ``above[p]`` the distance to the parent page's
    object, and ``first[p]``, ``size[p]``: its child pages, or rows if ``leaf[p]``; ``apart`` is the distance of each row
    to its leaf's object.
    """

    NAMES = ("centre", "radius", "above", "first", "size", "leaf", "apart")
    KINDS = (np.int32, np.float64, np.float64, np.int32, np.int32, np.bool_, np.float64)

    def __init__(self, x: np.ndarray, top: float, page: int = PAGE, fanout: int = FANOUT, seed: int = 11):
        up, rng = lifted(x, top), np.random.default_rng(seed)
        n = len(x)
        start = int(_far(up, up.mean(axis=0)).argmin())
        held = [(np.arange(n), start, 0.0)]  # rows, routing row and distance to the parent's, a page
        pages, at, order, apart = [], 0, [], []
        while at < len(held):
            rows, centre, above = held[at]
            d = _far(up[rows], up[centre])
            if len(rows) <= page:
                pages.append((centre, d.max(initial=0), above, len(order), len(rows), True))
                order.extend(rows.tolist())
                apart.extend(d.tolist())
            else:
                seeds = rng.choice(rows, min(fanout, -(-len(rows) // (page // 2))), replace=False)
                to = np.stack([_far(up[rows], up[s]) for s in seeds], axis=1).argmin(axis=1)
                to[np.searchsorted(rows, np.sort(seeds))] = np.argsort(seeds)  # a seed stays its own, also among equals
                first = len(held)
                for k, s in enumerate(seeds):
                    held.append((rows[to == k], int(s), float(_far(up[s], up[centre]))))
                pages.append((centre, d.max(initial=0), above, first, len(seeds), False))
                held[at] = None
            at += 1
        self.order = np.array(order, np.int64)
        back = np.empty(n, np.int64)
        back[self.order] = np.arange(n)
        columns = [*zip(*pages, strict=True)]
        for name, kind, values in zip(self.NAMES, self.KINDS, [*columns, apart], strict=True):
            setattr(self, name, np.array(values, kind))
        self.centre = back[self.centre].astype(np.int32)

    def packed(self) -> dict:
        return {name: getattr(self, name).tobytes() for name in self.NAMES}

    @classmethod
    def unpacked(cls, row) -> "Tree":
        tree = cls.__new__(cls)
        for name, kind in zip(cls.NAMES, cls.KINDS, strict=True):
            setattr(tree, name, np.frombuffer(row[name], kind))
        return tree

    def search(self, x: np.ndarray, low: np.ndarray, q: np.ndarray, top: float, k: int, bar=None):
        """Rows and scores of the k objects with the largest inner product, ties by ``low`` (their smallest ids), and
        the number of inner products made. ``x``: the objects in leaf order. With a ``bar``, objects under it may be
        left out."""
        base = float((q * q).sum()) + top
        slack = SLACK * base
        best = np.empty(0, np.int64)
        score = np.empty(0, x.dtype)

        def most(d):  # the best score at a distance of d or more
            return (base - np.square(np.maximum(d, 0))) / 2 + slack

        def far(s):
            return np.sqrt(np.maximum(base - 2 * np.asarray(s, np.float64), 0))

        made, full, exact = 1, False, x.dtype == object
        own = far(x[self.centre[0]] @ q)
        heap = [(-float(most(own - self.radius[0])), 0, float(own))]
        while heap:
            allowed, page, own = heapq.heappop(heap)
            if bar is not None and -allowed < bar:
                break
            leaf, at = self.leaf[page], slice(self.first[page], self.first[page] + self.size[page])
            apart, radius = (self.apart[at], 0.0) if leaf else (self.above[at], self.radius[at])
            if bar is not None:
                ok = most(np.abs(own - apart) - radius) >= bar
                left = np.count_nonzero(ok)
                if not left:
                    continue
                if 2 * left < len(ok):  # picking rows out costs more than a product: only where most are ruled out
                    at = at.start + np.flatnonzero(ok)
            if not leaf:
                s = x[self.centre[at]] @ q
                made += len(s)
                d = far(s)
                can = most(d - self.radius[at])
                pages = range(at.start, at.stop) if isinstance(at, slice) else at.tolist()
                for p, c, apart in zip(pages, can.tolist(), d.tolist(), strict=True):
                    if bar is None or c >= bar:
                        heapq.heappush(heap, (-c, p, apart))
                continue
            s = x[at] @ q
            made += len(s)
            if exact:
                s = np.clip(s, -MOST, MOST)
            if full and bar is not None:
                if s.max() < bar:
                    continue
                ok = np.flatnonzero(s >= bar)
                s = s[ok]
                at = ok + at.start if isinstance(at, slice) else at[ok]
            elif isinstance(at, slice):
                at = np.arange(at.start, at.stop)
            best, score = np.concatenate([best, at]), np.concatenate([score, s])
            keep = np.lexsort((low[best], -score))[:k]
            best, score = best[keep], score[keep]
            if len(best) == k:
                full, bar = True, score[-1] if bar is None else max(bar, score[-1])
                if bar <= -MOST:  # the least score there is: nothing is under it
                    bar = None
        return best, score, made


def objects(ints: DataFrame, k: int = K) -> DataFrame:
    """q and ids, the k + 1 smallest ids with that vector. A vector held by many rows is first cut down in salted groups."""
    rows = ints.where(F.col("vec_id").isNotNull()).select("vec_id", "q").distinct()
    few = (rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
           .withColumn("rn", F.row_number().over(Window.partitionBy("q", "salt").orderBy("vec_id"))).where(F.col("rn") <= k + 1))
    return few.groupBy("q").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"))


def _numbers(x: np.ndarray, exact: bool) -> np.ndarray:
    """Rows whose inner products are whole numbers without rounding: doubles below 2^53, else Python's integers."""
    return x.astype(object) if exact else x.astype(np.float64)


class Index:
    """``trees``: one row a shard; what queries need of it is of fixed size (the pivots, their radii and shard numbers)."""

    def __init__(self, ints: DataFrame, k: int = K, pivots: int = PIVOTS, shard_rows: int = SHARD_ROWS,
                 page: int = PAGE, fanout: int = FANOUT):
        self.k, self.spark = k, ints.sparkSession
        self.dim, size = extent(ints)
        self.exact = self.dim * size * size >= 1 << 53
        found = written(objects(ints, k), "metric-objects", "snappy")
        norm = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        self.top = float(found.agg(F.max(norm)).first()[0] or 0)
        picked = found.orderBy(F.xxhash64("q"), "q").limit(pivots).select("q").collect()
        self.pivots = np.array([[*r["q"], *[0] * (self.dim - len(r["q"]))] for r in picked], np.int64).reshape(len(picked), self.dim)
        dim, top, points = self.dim, self.top, lifted(self.pivots, self.top)

        def deal(batches):
            for batch in batches:
                up = lifted(matrix(batch.column("q"), dim), top)
                near = (up @ points.T).argmax(axis=1)  # all lifted norms are equal
                yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("ids"), pa.array(near, pa.int32()),
                                                  pa.array(_far(up, points[near]))], names=["q", "ids", "pivot", "far"])

        dealt = written(found.mapInArrow(deal, "q array<long>, ids array<long>, pivot int, far double"), "metric-dealt", "snappy")
        held = dealt.groupBy("pivot").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()  # one row a pivot
        self.shards = {r["pivot"]: -(-r["n"] // shard_rows) for r in held}
        self.radii = {r["pivot"]: r["far"] for r in held}
        shards = F.lit(1)
        for p, n in self.shards.items():
            shards = F.when(F.col("pivot") == p, F.lit(n)).otherwise(shards) if n > 1 else shards
        sub = F.pmod(F.xxhash64("q"), shards).cast("int")

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            x = matrix(pa.array(pdf["q"], pa.list_(pa.int64())), dim)
            tree = Tree(x, top, page, fanout)
            ids = [pdf["ids"].iloc[i] for i in tree.order]
            return pd.DataFrame([{"pivot": pdf["pivot"].iloc[0], "sub": pdf["sub"].iloc[0], "x": x[tree.order].tobytes(),
                                  "ids": np.concatenate(ids).astype(np.int64).tobytes(),
                                  "starts": np.cumsum([0, *map(len, ids)]).astype(np.int64).tobytes(),
                                  **tree.packed()}])

        kind = ("pivot int, sub int, x binary, ids binary, starts binary, "
                + ", ".join(f"{n} binary" for n in Tree.NAMES))
        count = max(1, sum(self.shards.values()))
        self.trees = written(dealt.withColumn("sub", sub).repartition(count, "pivot", "sub").groupBy("pivot", "sub")
                             .applyInPandas(build, kind), "metric-trees") if len(picked) else None

    def search(self, queries: DataFrame, query_block: int = QUERY_BLOCK) -> DataFrame:
        """query_id, rank, vec_id, score for ``queries`` (vec_id, q)."""
        none = "query_id long, rank int, vec_id long, score long"
        asked = queries.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").alias("query_id"), "q").distinct()
        if self.trees is None:
            return self.spark.createDataFrame([], none)
        asked = written(self._planned(written(asked.withColumn("qno", F.monotonically_increasing_id()), "metric-asked",
                                              "snappy")), "metric-queries", "snappy")
        blocks = max(1, -(-asked.count() // query_block))
        home = F.col("ways")[0]["pivot"]
        shards = F.create_map(*[F.lit(v) for kv in sorted(self.shards.items()) for v in kv])
        own = F.pmod(F.xxhash64("qno"), shards[home]).cast("int")
        near = (asked.select("qno", "query_id", "q", home.alias("pivot"), own.alias("sub"), F.lit(None).cast("long").alias("bar")))
        first = written(self._cells(near, blocks), "metric-first", "snappy")
        bars = first.where("bar is not null").groupBy("qno").agg(F.max("bar").alias("bar"))
        more = (asked.withColumn("home", home).withColumn("own", own).join(bars, "qno", "left")
                .select("qno", "query_id", "q", "bar", "home", "own", F.explode("ways").alias("way"))
                .where(F.col("bar").isNull() | (F.col("way.most") >= F.col("bar")))
                .withColumn("pivot", F.col("way.pivot"))
                .withColumn("sub", F.explode(F.sequence(F.lit(0), shards[F.col("pivot")] - 1)))
                .where((F.col("pivot") != F.col("home")) | (F.col("sub") != F.col("own")))
                .select("qno", "query_id", "q", "pivot", "sub", "bar"))
        found = first.unionByName(self._cells(more, blocks)).where("vec_id is not null")
        best = Window.partitionBy("qno").orderBy(F.desc("score"), "vec_id")
        return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= self.k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

    def _planned(self, asked: DataFrame) -> DataFrame:
        """Each query with its ways: the pivots and the best score that each one's radius allows, best first."""
        dim, top, points = self.dim, self.top, self.pivots.astype(np.float64)
        names = np.array(sorted(self.shards))
        radii = np.array([self.radii[int(p)] for p in names])

        def plan(batches):
            for batch in batches:
                q = matrix(batch.column("q"), dim).astype(np.float64)
                base = (q * q).sum(axis=1)[:, None] + top
                d = np.sqrt(np.maximum(base - 2 * (q @ points[names].T), 0))
                most = (base - np.maximum(d - radii, 0) ** 2) / 2 + SLACK * base
                order = d.argsort(axis=1, kind="stable")
                ways = [[{"pivot": int(names[i]), "most": float(m[i])} for i in o] for o, m in zip(order, most, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("qno", "query_id", "q")),
                     pa.array(ways, pa.list_(pa.struct([("pivot", pa.int32()), ("most", pa.float64())])))],
                    names=["qno", "query_id", "q", "ways"])
        return asked.select("qno", "query_id", "q").mapInArrow(
            plan, "qno long, query_id long, q array<long>, ways array<struct<pivot:int,most:double>>")

    def _cells(self, sent: DataFrame, blocks: int) -> DataFrame:
        """Answers of the (shard, query block) pairs that ``sent`` (qno, query_id, q, pivot, sub, bar) names."""
        dim, top, k, exact = self.dim, self.top, self.k, self.exact
        keys = ["pivot", "sub", "block"]
        # a null among longs would reach pandas as doubles, which round: no bar travels as a number below all scores
        sent = sent.withColumn("bar", F.coalesce("bar", F.lit(-MOST - 1)))
        sent = sent.withColumn("block", F.pmod(F.xxhash64("qno"), F.lit(blocks)).cast("int"))
        cells = sent.select("pivot", "sub", F.col("block").alias("block")).distinct()
        trees = self.trees.join(cells, ["pivot", "sub"])

        def answer(tree: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            out = {c: [] for c in ("qno", "query_id", "vec_id", "score", "bar")}
            if len(tree) and len(asked):
                row = tree.iloc[0]
                starts, ids = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["ids"], np.int64)
                x = _numbers(np.frombuffer(row["x"], np.int64).reshape(len(starts) - 1, dim), exact)
                q = _numbers(matrix(pa.array(asked["q"], pa.list_(pa.int64())), dim), exact)
                page, low = Tree.unpacked(row), ids[starts[:-1]]
                for i, (qno, own, bar) in enumerate(zip(asked["qno"], asked["query_id"], asked["bar"], strict=True)):
                    best, score, _ = page.search(x, low, q[i], top, k + 1, None if bar < -MOST else int(bar))
                    rows = sorted((-int(s), int(v)) for b, s in zip(best, score, strict=True)
                                  for v in ids[starts[b]:starts[b + 1]] if v != own)[:k]
                    # k answers or more elsewhere must reach the k-th here
                    bar = -rows[-1][0] if len(rows) == k and rows[-1][0] < MOST else None
                    for s, v in rows or [(None, None)]:
                        out["qno"].append(int(qno))
                        out["query_id"].append(int(own))
                        out["vec_id"].append(v)
                        out["score"].append(None if s is None else -s)
                        out["bar"].append(bar)
            return pd.DataFrame({c: pd.array(v, "Int64") for c, v in out.items()})

        left = trees.repartition(*keys).groupBy(*keys)
        return left.cogroup(sent.groupBy(*keys)).applyInPandas(
            answer, "qno long, query_id long, vec_id long, score long, bar long")


def op12_metric_tree_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ints = written(quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "metric-input", "snappy")
    return Index(ints).search(ints.where(F.col("vec_id") % EVERY == 0))


SQL = """WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM ints a JOIN ints b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
