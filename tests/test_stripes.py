"""Pairs and scores that travel as packed lists of a user's or an item's entries."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators import similarity
from tandem.operators.similarity import cooccurrence, covisitation_scores, sparsify, upper_pairs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _brute(counts):
    users: dict = {}
    for u, i, n in counts:
        users.setdefault(u, []).append((i, n))
    out: dict = {}
    for held in users.values():
        for i, n in held:
            for j, m in held:
                if i != j:
                    out[i, j] = out.get((i, j), 0) + n * m
    return out


@pytest.fixture(scope="module")
def counts():
    rng = np.random.default_rng(5)
    ids = [-(1 << 62), -7, 3, 250, 256, 70_000, 1 << 40, (1 << 62) + 5] + list(range(1000, 1060))
    return [(u, ids[i], int(n)) for u in range(40)
            for i, n in zip(rng.choice(len(ids), 3 + u, replace=False), rng.choice([1, 1, 1, 300], 3 + u), strict=True)]


@pytest.mark.parametrize("heavy, salt", [(2000, 64), (5, 64), (5, 3)])
def test_pairs_of_any_ids_and_counts(spark, counts, heavy, salt):
    df = spark.createDataFrame([*counts, (None, 3, 1), (1, None, 1)], "uid long, item_id long, n long")
    want = _brute(counts)
    got = {(r.item_i, r.item_j): r.w for r in upper_pairs(df, heavy, salt).collect()}
    assert got == {k: w for k, w in want.items() if k[0] < k[1]}
    both = {(r.item_i, r.item_j): r.w for r in similarity._pairs(df, False, None, heavy, salt, pairs=50).collect()}
    assert both == want


def test_top_pairs_need_no_exchange_of_pairs(spark, counts):
    likes = spark.createDataFrame([(u, i) for u, i, n in counts for _ in range(n % 7)], "uid long, item_id long")
    counted = [(u, i, n % 7) for u, i, n in counts]
    want: dict = {}
    for (i, j), w in _brute(counted).items():
        want.setdefault(i, []).append((-w, j))
    want = {(i, j, -w) for i, held in want.items() for w, j in sorted(held)[:4]}
    assert {tuple(r) for r in sparsify(cooccurrence(likes, most=4), 4).select("item_i", "item_j", "w").collect()} == want
    assert cooccurrence(likes, most=4).count() == len(want)  # no more leaves the tasks that hold an item's pairs
    assert "hashpartitioning(item_i" not in _plan(upper_pairs(likes.groupBy("uid", "item_id").agg(F.count("*").alias("n"))))


def test_scores_are_added_up_from_lists(spark):
    likes = spark.createDataFrame([(1, 10, 5, 1), (1, 10, 4, 0), (1, 20, 3, 1), (1, 30, 1, 1), (2, 99, 1, 1), (None, 10, 1, 1)],
                                  "uid long, item_id long, timestamp long, is_organic int")
    s = spark.createDataFrame([(10, 1, 7), (10, 2, 1), (20, 2, 100_000), (20, 3, 13), (20, 4, 14), (30, 1, 900)],
                              "item_i long, item_j long, w long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "uid long")
    scored = covisitation_scores(likes, s, users, 3, 3)
    assert sorted(map(tuple, scored.collect())) == [(1, 1, 14.0), (1, 2, 100_002.0), (1, 4, 14.0)]
    assert not re.search(r"hashpartitioning\(uid#\d+L, item", _plan(scored))  # dealt by user alone


def test_sampled_users_are_read_from_files(spark, tmp_path):
    """The capped likes are computed once, not for each count and join."""
    from tandem.plans import catalog
    from tandem.sources import testdata as td

    n = 300
    spark.range(n).select(F.col("id").alias("l_orderkey"), (F.col("id") % 20).alias("l_partkey"),
                          F.lit("2024-01-01").cast("date").alias("l_shipdate"), F.lit("N").alias("l_returnflag")
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey")).write.parquet(
        f"{tmp_path}/orders.parquet")
    got = catalog.QUERIES["user_sample_to_target"](spark, str(tmp_path))
    assert "lineitem" not in _plan(got) and "o_custkey" not in _plan(got)
    held = got.groupBy("uid").count().collect()
    assert len(held) == 20 and {r["count"] for r in held} == {5}
    assert got.join(td.likes(spark, str(tmp_path)), ["uid", "item_id", "timestamp", "is_organic"], "left_anti").count() == 0


def test_ranked_pairs_are_dealt_by_user_once(spark, tmp_path):
    """Vectors and likes of the top items are sent to the pairs; the rank needs no exchange of them."""
    from tandem.plans import catalog

    spark.range(400).select(F.col("id").alias("l_orderkey"), (F.col("id") % 30).alias("l_partkey"),
                            F.lit("2024-01-01").cast("date").alias("l_shipdate"), F.lit("N").alias("l_returnflag")
                            ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(400).select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey")).write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.range(60).select(F.when(F.col("id") < 59, F.col("id")).alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding")
                           ).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = catalog.QUERIES["pair_dot_rank"](spark, str(tmp_path))
    assert "hashpartitioning(uid#" in _plan(got) and _plan(got).count("hashpartitioning") == 1
    seen = {(k % 50, k % 30) for k in range(400)}
    want = {}
    for u in [*range(59), None]:
        for i in range(30):
            if (u, i) not in seen:
                want[u, i] = round(float(u * i + 1), 4) if u is not None and u < 40 else 0.0
    assert {(r.uid, r.item_id): r.als_dot for r in got.collect()} == want
    ranks = {(r.uid, r.item_id): r.als_rank for r in got.collect()}
    assert all(ranks[u, i] == 1 + sum(v > d for (a, _), v in want.items() if a == u) for (u, i), d in want.items())
