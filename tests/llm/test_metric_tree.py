"""Metric-tree search against all inner products."""

import math

import numpy as np
import pytest

from tandem.llm import metric_tree as mt
from tandem.llm.int_vectors import quantised

SCHEMA = "vec_id long, embedding array<double>, rank int, score string, q int"


def plain(rows, k, every=50):
    kept = sorted({(r[0], tuple(min(max(math.floor(256 * x) if abs(x) < 2**60 else int(x) * 256, 1 - 2**63), 2**63 - 1) for x in r[1]))
                   for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])})
    out = []
    for i, q in kept:
        if i % every == 0:
            near = sorted((-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, v, strict=False)))), j)
                          for j, v in kept if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return sorted(out)


def found(spark, rows, k=5, **settings):
    ints = quantised(spark.createDataFrame(rows, SCHEMA)).persist()
    df = mt.Index(ints, k, **settings).search(ints.where("vec_id % 50 = 0"), query_block=40)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("settings", [{}, {"pivots": 5, "shard_rows": 100, "page": 8, "fanout": 3}])
def test_exact_against_all(spark, settings):
    r = np.random.default_rng(4)
    centres = 3 * r.normal(size=(9, 12))
    x = (centres[r.integers(0, 9, 900)] + 0.1 * r.normal(size=(900, 12))).round(2)
    x[300:600] = x[0]       # a hot vector
    x[600:640] = -x[0]      # least scores, many ties
    rows = [(int(i) * 2, v.tolist(), 1, "s", 2) for i, v in enumerate(x)]
    rows += [(1, None, 1, "", 2), (50_000, [float("nan")] * 12, 1, "", 2), (3, [None] * 12, 1, "", 2), (None, x[0].tolist(), 1, "", 2),
             (51_000, [0.0] * 12, 1, "", 2), (5, [1.0, 2.0], 1, "", 2), (52_000, [], 1, "", 2),
             (100, x[700].tolist(), 1, "", 2), rows[7]]
    assert found(spark, rows, **settings) == plain(rows, 5)


def test_bounds_save_inner_products():
    r = np.random.default_rng(5)
    centres = 400 * r.normal(size=(40, 8))
    x = np.floor(centres[r.integers(0, 40, 4000)] + 8 * r.normal(size=(4000, 8))).astype(np.int64)
    top = float((x * x).sum(axis=1).max())
    tree = mt.Tree(x, top, page=32, fanout=8)
    y, made = x[tree.order].astype(float), 0
    for q in y[::100]:
        best, score, n = tree.search(y, np.arange(4000), q, top, 6)
        want = sorted(zip(-(y @ q), range(4000), strict=True))[:6]
        assert [(-s, b) for b, s in zip(best, score, strict=True)] == want
        made += n
    assert made < 0.5 * 4000 * 40
    assert sorted(tree.order) == list(range(4000)) and (tree.size[tree.leaf] <= 32).all()


def test_large_numbers_few_and_none(spark):
    r = np.random.default_rng(6)
    rows = [(i, (1e9 * v).tolist(), 0, "", 0) for i, v in enumerate(r.normal(size=(60, 4)))]
    rows += [(100, [1e25] * 4, 0, "", 0), (101, [-1e25] * 4, 0, "", 0)]
    assert found(spark, rows) == plain(rows, 5)
    few = [(0, [1.0, 0.0], 0, "", 0), (1, [0.5, 0.5], 0, "", 0), (2, [1.0, 0.0], 0, "", 0)]
    assert found(spark, few) == plain(few, 5) == [(0, 1, 2, 65536), (0, 2, 1, 32768)]
    assert found(spark, [(0, [1.0], 0, "", 0)]) == []
    assert found(spark, []) == []
