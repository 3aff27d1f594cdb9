"""Nearest neighbours by inner product with robust-pruned directed graphs, one a shard.

Every vector is indexed. A shard (vectors dealt by a hash of their values) is built in one task: vectors enter in
batches, a greedy beam search over the graph so far proposes neighbours, and relaxed pruning keeps an edge p-q only
if no kept neighbour r of p is nearer to q by the factor ``alpha`` (diverse edges); reverse edges are added and
over-full vertices pruned again. Queries beam-search every shard; the shards' answers merge to the k best.

Equal vectors are one vertex with a list of ids, so a hot vector with any number of copies adds no edge. A vertex
stands for its k + 1 smallest ids: no answer can hold more of them.

The graph lives in the space of inner products: vectors get one more coordinate that makes all norms equal (the
largest norm in the shard), in which order by distance is order by inner product. Answers are scored anew by the
inner product of the original vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.llm.common import prepare, written

K = 20
DEGREE = 32
BEAM = 64
SEARCH_BEAM = 192
ALPHA = 1.2
SHARD_ROWS = 8192
BATCH = 256
QUERY_BLOCK = 4096


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v (array<double>) of the vectors that take part: not null, not zero, all components finite."""
    v = F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
                   & ~F.coalesce(F.exists("v", bad), F.lit(True)) & F.exists("v", lambda x: x != 0)))


class Graph:
    """A robust-pruned directed graph over the rows of ``x``."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 7):
        self.n, self.degree, self.alpha = len(x), degree, alpha
        norm = (x * x).sum(axis=1)
        lift = np.sqrt(np.maximum(norm.max(initial=0) - norm, 0))
        self.x = np.ascontiguousarray(np.concatenate([x, lift[:, None]], axis=1), np.float32)
        self.edges = np.full((self.n, degree), -1, np.int32)
        mean = self.x.mean(axis=0) if self.n else 0
        self.entry = int(((self.x - mean) ** 2).sum(axis=1).argmin()) if self.n else -1
        order = np.random.default_rng(seed).permutation(self.n)
        order = np.concatenate([[self.entry], order[order != self.entry]]).astype(np.int64) if self.n else order
        first = order[:degree + 1]  # a clique to begin with
        for i in first:
            own = first[first != i][:degree]
            self.edges[i, :len(own)] = own
        at, size = len(first), 16
        while at < self.n:  # batches grow with the graph, so that early vertices see each other
            batch = order[at:at + size]
            self._insert(batch, beam)
            at, size = at + len(batch), min(BATCH, 2 * size)
        for at in range(0, self.n, BATCH):  # once more, now that the whole graph is there to be searched
            self._insert(order[at:at + BATCH], beam)

    def _insert(self, batch: np.ndarray, beam: int) -> None:
        seen, dist = self.beam(self.x[batch], beam, lifted=True)
        old = self.edges[batch]
        near = np.concatenate([seen, old], axis=1)
        near[near == batch[:, None]] = -1
        self.edges[batch] = self._prune(batch, near)
        src = np.repeat(batch, self.degree)
        dst = self.edges[batch].ravel()
        ok = dst >= 0
        src, dst = src[ok], dst[ok].astype(np.int64)
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        to, start, n = np.unique(dst, return_index=True, return_counts=True)
        # all back edges of a vertex, at most 3 * degree at a time, go through the same pruning
        width = 3 * self.degree
        for lo in range(0, int(n.max(initial=0)), width):
            rows = np.flatnonzero(n > lo)
            col = np.arange(lo, lo + min(width, int(n.max()) - lo))
            held = col[None, :] < n[rows, None]
            more = np.where(held, src[np.minimum(start[rows, None] + col[None, :], len(src) - 1)], -1)
            for a in range(0, len(rows), BATCH):
                v = to[rows[a:a + BATCH]]
                both = np.concatenate([self.edges[v], more[a:a + BATCH].astype(np.int32)], axis=1)
                self.edges[v] = self._prune(v, both)

    def _prune(self, at: np.ndarray, near: np.ndarray) -> np.ndarray:
        """The kept neighbours of each vertex out of ``near`` (-1: none), nearest first."""
        near = np.sort(near, axis=1)[:, ::-1].copy()
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        x = self.x[near]
        d = ((x - self.x[at][:, None, :]) ** 2).sum(axis=2)
        d[near < 0] = np.inf
        order = np.argsort(d, axis=1, kind="stable")[:, :4 * self.degree]
        near, d = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
        x = np.take_along_axis(x, order[:, :, None], 1)
        sq = (x * x).sum(axis=2)
        out = np.full((len(at), self.degree), -1, np.int32)
        live, row = np.isfinite(d), np.arange(len(at))
        for k in range(self.degree):
            p = live.argmax(axis=1)
            any_ = live[row, p]
            if not any_.any():
                break
            out[any_, k] = near[row, p][any_]
            c = x[row, p]
            between = sq + sq[row, p][:, None] - 2 * np.einsum("bnd,bd->bn", x, c)
            live &= ~(self.alpha * between <= d)
            live[row, p] = False
        return out

    def beam(self, q: np.ndarray, width: int, lifted: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest vertices found for each query, and their distances; all queries step together."""
        if not lifted:
            q = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
        b = len(q)
        ids = np.full((b, width), -1, np.int32)
        dist = np.full((b, width), np.inf, np.float32)
        done = np.ones((b, width), bool)
        ids[:, 0], done[:, 0] = self.entry, False
        dist[:, 0] = ((q - self.x[self.entry]) ** 2).sum(axis=1)
        live = np.arange(b)
        while len(live):
            open_ = ~done[live]
            go = open_.any(axis=1)
            live, open_ = live[go], open_[go]
            if not len(live):
                break
            p = open_.argmax(axis=1)
            done[live, p] = True
            new = self.edges[ids[live, p]]
            known = (new[:, :, None] == ids[live][:, None, :]).any(axis=2) | (new < 0)
            d = ((self.x[new] - q[live][:, None, :]) ** 2).sum(axis=2)
            d[known] = np.inf
            all_d = np.concatenate([dist[live], d], axis=1)
            order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
            dist[live] = np.take_along_axis(all_d, order, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), order, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], known], axis=1), order, 1)
            done[live] |= ~np.isfinite(dist[live])
        return ids, dist


GRAPHS = "shard int, vecs binary, ids binary, starts binary, edges binary, entry int, n int, dim int"


def padded(vectors, dim: int) -> np.ndarray:
    """Rows of ``dim`` numbers; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), dim))
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v[:dim]
    return out


def _built(degree: int, beam: int, alpha: float, most: int, dim: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = padded(pdf["v"], dim)
        order = np.lexsort((pdf["vec_id"], *x.T))
        x, ids = x[order], pdf["vec_id"].to_numpy(np.int64)[order]
        head = np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])
        begin = np.flatnonzero(head)
        n = np.diff([*begin, len(x)])
        first = np.concatenate([np.arange(b, b + min(most, c)) for b, c in zip(begin, n, strict=True)])
        starts = np.concatenate([[0], np.cumsum(np.minimum(most, n))])
        graph = Graph(x[begin], degree, beam, alpha)
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "vecs": [x[begin].tobytes()], "ids": [ids[first].tobytes()],
                             "starts": [starts.astype(np.int64).tobytes()], "edges": [graph.edges.tobytes()],
                             "entry": [graph.entry], "n": [len(begin)], "dim": [x.shape[1]]})
    return run


def build(vectors: DataFrame, k: int = K, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a shard with its graph. ``vectors``: vec_id, v as ``usable`` gives them; a shorter
    vector counts as padded with zeros to the longest.

    Of equal vectors only the ``k`` + 1 smallest ids are kept, before anything is shuffled by shard; shards are dealt
    by value, so all copies of a vector meet in one.
    """
    key = F.xxhash64("v")
    # partial aggregation: each task keeps a bounded list of the smallest ids of a vector
    few = (vectors.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
           .withColumn("rn", F.row_number().over(Window.partitionBy("v", "salt").orderBy("vec_id")))
           .where(F.col("rn") <= k + 1).drop("rn", "salt"))
    few = written(few, "ann-vectors", "snappy")
    n, dim = few.agg(F.count("*"), F.max(F.size("v"))).first()
    shards = max(1, -(-n // shard_rows))
    dealt = few.withColumn("shard", F.pmod(key, F.lit(shards)).cast("int"))
    return written(dealt.groupBy("shard").applyInPandas(_built(degree, beam, alpha, k + 1, dim or 0), GRAPHS), "ann-graphs")


def _answers(k: int, width: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=columns)
        r = left.iloc[0]
        x = np.frombuffer(r["vecs"], np.float64).reshape(r["n"], r["dim"])
        ids, starts = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["starts"], np.int64)
        graph = Graph.__new__(Graph)
        norm = (x * x).sum(axis=1)
        graph.x = np.concatenate([x, np.sqrt(norm.max() - norm)[:, None]], axis=1).astype(np.float32)
        graph.edges = np.frombuffer(r["edges"], np.int32).reshape(r["n"], -1)
        graph.entry, graph.n = int(r["entry"]), int(r["n"])
        out = []
        for at in range(0, len(right), BATCH):
            part = right.iloc[at:at + BATCH]
            q = padded(part["v"], r["dim"])
            found, _ = graph.beam(q, max(width, k + 1))
            for own, one, near in zip(part["vec_id"].to_numpy(), q, found, strict=True):
                near = near[near >= 0]
                score = (x[near] * one).sum(axis=1)
                order = np.lexsort((ids[starts[near]], -score))[:k + 1]
                near, score = near[order], score[order]
                rows = [(int(i), float(s)) for v, s in zip(near, score, strict=True)
                        for i in ids[starts[v]:starts[v + 1]] if i != own]
                rows.sort(key=lambda z: (-z[1], z[0]))
                out += [(int(own), i, s) for i, s in rows[:k]]
        return pd.DataFrame(out, columns=columns)
    return run


def search(graphs: DataFrame, queries: DataFrame, k: int = K, width: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the k best found for each query (vec_id, v), its own id left out; ties go to the
    smaller id. All query blocks meet all shards, k rows of each pair remain."""
    spark = graphs.sparkSession
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    shards = graphs.select("shard")
    pairs = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    names = [r[0] for r in shards.collect()]  # one number a shard
    if not names:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sent = pairs.withColumn("shard", F.explode(F.array(*[F.lit(s) for s in names])))
    asked = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = asked.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInPandas(
        _answers(k, width), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op3_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    graphs = build(vectors)
    return search(graphs, vectors.where(F.col("vec_id") % 20 == 0))
