from pyspark.sql import functions as F

from tandem.operators import sampling, topk
from tests.conftest import rows


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1, v) for v in (9, 7, 7, 5, 3, 3, 3)], "g long, n long")
    ranked = topk.average_rank_filter(df, "g", "n", 100, out="r")
    assert rows(ranked, "n", "r") == sorted([(9, 1.0), (7, 2.5), (7, 2.5), (5, 4.0), (3, 6.0), (3, 6.0), (3, 6.0)])
    assert topk.average_rank_filter(df, "g", "n", 5).count() == 4
    assert topk.average_rank_filter(df, "g", "n", 2).count() == 1


def test_recent_per_user_tie_break(likes):
    two = topk.recent_per_user(likes.where("uid = 1"), 2)
    assert rows(two, "item_id") == [(20,), (30,)]
    one = topk.recent_per_user(likes.where("uid = 1"), 1)
    assert rows(one, "item_id") == [(20,)]


def test_global_top_n_tie_break(likes):
    from tandem.operators.interactions import item_counts
    top = topk.global_top_n(item_counts(likes), [F.desc("n"), F.asc("item_id")], 2)
    assert rows(top, "item_id", "n") == [(10, 3), (20, 2)]


def test_global_index_exact_and_partition_independent(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("a"), F.col("id").alias("b"))
    for parts in (1, 3, 16):
        idx = topk.global_index(df, ["a", "b"], "idx", num_partitions=parts)
        got = [r["b"] for r in idx.orderBy("idx").collect()]
        want = [r["b"] for r in df.orderBy("a", "b").collect()]
        assert got == want
        assert idx.agg(F.min("idx"), F.max("idx")).first() == (0, 4999)


def test_latest_events(likes):
    out = topk.latest_events(likes, 3)
    assert sorted(r["timestamp"] // 86400 for r in out.collect()) == [300, 400, 400]


def test_select_k_by_hash_exact(spark):
    keys = spark.range(0, 20000).withColumnRenamed("id", "uid")
    for k in (0, 1, 777, 20000, 25000):
        chosen = sampling.select_k_by_hash(keys, "uid", k, seed=42)
        assert chosen.count() == min(k, 20000)
    a = {r.uid for r in sampling.select_k_by_hash(keys, "uid", 500, 42).collect()}
    b = {r.uid for r in sampling.select_k_by_hash(keys.repartition(7), "uid", 500, 42).collect()}
    assert a == b


def test_downsample_keeps_positives(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("uid"), (F.col("id") * 7).alias("item_id"),
                                      (F.col("id") % 50 == 0).cast("int").alias("target"))
    out = sampling.downsample_negatives(df, 0.05, 42)
    assert out.where("target = 1").count() == 400
    neg = out.where("target = 0").count()
    assert 0.04 * 19600 < neg < 0.06 * 19600
    assert rows(out) == rows(sampling.downsample_negatives(df.repartition(5), 0.05, 42))


def test_temporal_split_windows(likes):
    hist, train, val_hist, val = sampling.temporal_split(likes, 1)
    total = likes.count()
    assert hist.count() + train.count() + val.count() == total
    assert val_hist.count() == hist.count() + train.count()


def test_positional_split(likes):
    out = sampling.positional_split(likes)
    parts = dict(out.groupBy("part").count().collect())
    assert parts == {"hist": 5, "train": 2, "val": 2}


def test_cap_history(likes):
    out = sampling.cap_history(likes, 1)
    assert rows(out, "uid", "item_id") == [(1, 20), (2, 20), (3, 30), (4, 99)]


def test_global_index_without_exchange_reuse(spark):
    df = spark.range(0, 3000).select((F.col("id") % 31).alias("a"), F.col("id").alias("b"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        idx = topk.global_index(df, ["a", "b"], "idx", num_partitions=5)
        assert idx.agg(F.countDistinct("idx"), F.min("idx"), F.max("idx")).first() == (3000, 0, 2999)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
