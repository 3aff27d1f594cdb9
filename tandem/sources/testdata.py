"""Adapter from the driver's TPC-H-like tables to the recommender's tables.

likes           = one row per lineitem: customer likes part at ship date
artist_mapping  = part -> brand number
target_users    = every customer

All three are lazy DataFrames; Catalyst prunes the unused lineitem/orders
columns and pushes time filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").cast("long").alias("uid"),
                    F.col("l_partkey").cast("long").alias("item_id"),
                    F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("long").alias("timestamp"),
                    (F.col("l_returnflag") == F.lit("N")).cast("int").alias("is_organic")))


def artist_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "part")
            .select(F.col("p_partkey").cast("long").alias("item_id"),
                    F.substring("p_brand", 7, 10).cast("long").alias("artist_id")))


def artist_mapping_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-to-many mapping: every 10th part gets a second artist, and parts
    whose key is divisible by 17 have a null artist (FIXTURES.md §2)."""
    part = table(spark, sf_dir, "part")
    base = part.select(F.col("p_partkey").cast("long").alias("item_id"),
                       F.substring("p_brand", 7, 10).cast("long").alias("artist_id"))
    extra = (part.where(F.col("p_partkey") % 10 == 0)
             .select(F.col("p_partkey").cast("long").alias("item_id"),
                     (F.lit(100) + F.col("p_size")).cast("long").alias("artist_id")))
    both = base.unionByName(extra)
    return both.select("item_id",
                       F.when(F.col("item_id") % 17 == 0, F.lit(None).cast("long"))
                       .otherwise(F.col("artist_id")).alias("artist_id"))


def target_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("uid"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as an ``(id, features)`` factor table."""
    return (table(spark, sf_dir, "embeddings")
            .select(F.col("vec_id").cast("long").alias("id"),
                    F.col("embedding").cast("array<float>").alias("features")))
