"""Graph search against brute force."""

import numpy as np
import pytest

from tandem.llm import graph_search as gs


def clustered(n, dim, seed, copies=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dim))
    x = centres[r.integers(0, 12, n)] + 0.5 * r.normal(size=(n, dim))
    x *= r.uniform(0.5, 2, (n, 1))
    x[:copies] = x[0]
    return x


def exact(ids, x, q, k):
    out = {}
    for i in q:
        s = (x * x[ids.index(i)]).sum(axis=1)
        order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-s[j], ids[j]))[:k]
        out[i] = [(ids[j], s[j]) for j in order]
    return out


@pytest.mark.parametrize("shard_rows", [10_000, 400])
def test_recall_and_scores(spark, shard_rows):
    x = clustered(1500, 16, 3, copies=60)
    ids = list(range(0, 3000, 2))
    rows = [(i, v.tolist(), "l", 1) for i, v in zip(ids, x, strict=True)]
    rows += [(9001, None, "l", 1), (9003, [0.0] * 16, "l", 1), (9005, [float("nan")] * 16, "l", 1),
             (9007, [None] * 16, "l", 1), (9009, [float("inf")] + [1.0] * 15, "l", 1), (None, [1.0] * 16, "l", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, shard int")
    vectors = gs.usable(df)
    assert vectors.count() == 1500
    got = {}
    for r in gs.search(gs.build(vectors, shard_rows=shard_rows), vectors.where("vec_id % 20 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, 21)) and q not in [i for _, i, _ in own]
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        assert all(abs(s - (x[ids.index(i)] * x[ids.index(q)]).sum()) < 1e-12 * 100 for _, i, s in own)
        hits += len({i for _, i, _ in own} & {i for i, _ in near})
    assert hits >= 0.95 * 20 * len(want)


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<double>"
    few = gs.usable(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0])], schema))
    rows = gs.search(gs.build(few), few.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in rows] == [(1, 2, 1.0), (2, 1, 0.5)]
    none = gs.usable(spark.createDataFrame([], schema))
    assert gs.search(gs.build(none), none).count() == 0


def test_pruning_keeps_diverse_edges():
    # three points in a row and one aside: the far one in the row is reached through the near one
    x = np.array([[0.0, 0], [1, 0], [2, 0], [0, 1.5]])
    g = gs.Graph(x, degree=3)
    kept = g._prune(np.array([0]), np.array([[1, 2, 3]], np.int32))[0]
    assert kept[0] == 1 and 3 in kept and 2 not in kept


def test_vectors_of_unequal_length(spark):
    x = clustered(300, 8, 9)
    x[::7, 5:] = 0.0
    rows = [(i, v[:5].tolist() if i % 7 == 0 else v.tolist()) for i, v in enumerate(x)]
    vectors = gs.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {}
    for r in gs.search(gs.build(vectors, shard_rows=100), vectors.where("vec_id % 20 = 0")).collect():
        got.setdefault(r["query_id"], set()).add((r["vec_id"], round(r["score"], 9)))
    want = exact(list(range(300)), x, range(0, 300, 20), 20)
    hits = sum(len(got[q] & {(i, round(s, 9)) for i, s in near}) for q, near in want.items())
    assert set(got) == set(want) and hits >= 0.95 * 20 * len(want)
