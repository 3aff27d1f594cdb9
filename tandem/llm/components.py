"""Connected components of a link table by min-label contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import written


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node that occurs in ``links``.

    Large-star and small-star rounds: every node's larger neighbours are hung on its smallest neighbour, then its
    smaller ones are, until nothing changes; the number of rounds grows with the logarithm of the largest component.
    Links never multiply: a round has at most one link for each link before it. Each round is written to the shared
    folder. Null ends, loops and repeated links are ignored.
    """
    edges = written(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                    .where("u is not null and v is not null and u <> v").distinct(), "links", "snappy")

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        # large star: links (u, v), u > v, of every node to its larger neighbours go to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        hung = (both.where("v > u").join(low, F.col("u") == F.col("k"))
                .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = hung.where("u <> v").distinct()
        # small star: each node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        edges = written(small.where("u <> v").distinct(), "links", "snappy")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
