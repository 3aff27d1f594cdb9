"""ALS half-steps over blocks, the searches over their factors, and shuffle files that do not stay."""

import numpy as np
from pyspark.sql import functions as F

from tandem.operators import als
from tandem.operators.vectors import topk_inner_product
from tandem.plans import checks
from tandem.sources.io import CLEANUP, materialise


def test_solve_is_the_normal_equations():
    rng = np.random.default_rng(1)
    y, count = rng.normal(size=(60, 6)), np.array([1, 6, 3, 40, 7, 2, 2])
    col = np.concatenate([rng.choice(60, k, replace=False) for k in count])
    c, gram = rng.uniform(1, 80, len(col)), y.T @ y
    got = als.solve(y, count, col, c, gram, 0.1)
    for i, (at, k) in enumerate(zip(np.cumsum(count) - count, count, strict=True)):
        g, own = y[col[at:at + k]], c[at:at + k]
        want = np.linalg.solve(gram + 0.1 * k * np.eye(6) + (g * own[:, None]).T @ g, (1 + own) @ g)
        assert np.allclose(got[i], want, rtol=1e-9, atol=1e-12)


def test_fit_is_that_of_spark_ml(spark):
    from pyspark.ml.recommendation import ALS

    rng = np.random.default_rng(2)
    rows = [(int(u) - 5, int(i) * 7, float(rng.integers(1, 4) * 40 - 1)) for u in range(70) for i in rng.choice(45, rng.integers(1, 30), replace=False)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating float")
    ml = lambda n: ALS(rank=8, maxIter=n, regParam=0.1, alpha=1.0, implicitPrefs=True, seed=7, userCol="user", itemCol="item",
                       ratingCol="rating").fit(ratings)
    want = ml(4)
    for blocks in (1, 5):
        for got, ref in zip(als.fit(ratings, ml(0).userFactors, 8, 4, 0.1, blocks), (want.userFactors, want.itemFactors), strict=True):
            got, ref = ({r["id"]: r["features"] for r in df.collect()} for df in (got, ref))
            assert got.keys() == ref.keys()
            assert all(np.allclose(got[k], ref[k], rtol=1e-3, atol=1e-5) for k in ref)


def test_searches_agree_and_little_comes_back(spark):
    """Past the first block only what reaches a query's bar is returned, and brute force finds the same."""
    rng = np.random.default_rng(3)
    make = lambda x: spark.createDataFrame([(k, [float(v) for v in r]) for k, r in enumerate(x)], "id long, features array<float>")
    q, items = rng.normal(size=(30, 5)), rng.normal(size=(400, 5)) * np.linspace(0.1, 3, 400)[:, None]
    same = lambda df, key: sorted((r[key], r["item_id"], round(r["score"], 9)) for r in df.collect())
    got = same(topk_inner_product(make(q), make(items), 7, query_block_rows=16, item_block_rows=50), "qid")
    assert got == same(checks.best_of_all(make(q), make(items), 7), "qid") and len(got) == 210
    from tandem.operators.vectors import _block_topk
    import pandas as pd
    block = pd.DataFrame({"_iid": range(400), "_if": [r.astype("f4") for r in items]})
    bars = np.sort(q.astype("f4").astype(float) @ items.astype("f4").astype(float).T, axis=1)[:, -3]
    few = _block_topk(7)(None, pd.DataFrame({"qid": range(30), "_qf": [r.astype("f4") for r in q], "bar": bars - 1e-9}), block)
    assert few.groupby("qid").size().tolist() == [3] * 30


def test_normal_equations_know_wrong_factors(spark):
    from tandem.plans.retrieval import IALS

    likes = spark.createDataFrame([(u, i) for u in range(9) for i in range(6) if (u * i + u) % 3], "uid long, item_id long")
    g = IALS(factors=4, iterations=3).fit(likes)
    assert {r["ok"] for r in checks.als_normal_equations(g, likes).collect()} == {True}
    g.user_factors = g.user_factors.withColumn("features", F.when(F.col("id") == 4, F.transform("features", lambda x: x * 2)).otherwise(F.col("features")))
    assert [r["uid"] for r in checks.als_normal_equations(g, likes).collect() if not r["ok"]] == [4]


def test_written_tables_leave_no_shuffle_files(spark):
    before = spark.conf.get(CLEANUP, None)
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = tracker.shuffleStatuses().size()
    rows = materialise(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().repartition(3))
    assert tracker.shuffleStatuses().size() <= held
    assert rows.count() == 10 and spark.conf.get(CLEANUP, None) == before
