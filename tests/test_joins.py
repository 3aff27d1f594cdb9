"""Broadcasts are bounded in rows and in bytes."""

from pyspark.sql import functions as F

from tandem.operators.joins import bounded_broadcast, is_small, size_of


def is_broadcast(df):
    return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_sizes_count_what_values_hold(spark):
    df = spark.createDataFrame([(1, "abcd", [1.0] * 100), (2, None, None)], "id long, s string, v array<double>")
    rows, held = size_of(df)
    assert rows == 2 and 2 * 24 + 4 + 800 - 8 <= held <= 2 * 24 + 4 + 800
    assert size_of(df.limit(0)) == (0, 0)


def test_few_long_rows_are_not_small(spark):
    wide = spark.range(1000).select("id", F.array_repeat(F.lit(1.0), 500).alias("v"))
    assert is_small(wide, 1000) and not is_small(wide, 999) and not is_small(wide, 1000, 1 << 20)
    left = spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert is_broadcast(left.join(bounded_broadcast(wide), "id"))
        assert not is_broadcast(left.join(bounded_broadcast(wide, max_bytes=1 << 20), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
