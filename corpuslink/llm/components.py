"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller id."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every id with a link to another one.

    ``links`` has two columns of ids; null ids and links of an id to itself are left out. Every
    round joins each neighbour to the smallest one it sees (large star, then small star); the
    number of rounds grows with the logarithm of the longest chain. One row per round reaches the
    driver."""
    one, two = links.columns
    edges = cut_lineage(
        links.where(F.col(one) != F.col(two))
        .select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b"))
        .distinct()
    )
    seen = None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    lows = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(lows)
