"""Connected components of a distributed edge list (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import stage


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` reaches.

    Large-star links every larger neighbour of a node to the smallest one,
    small-star every smaller neighbour; both need a node's minimum only, which
    is combined before the shuffle, so a node with very many neighbours is no
    hot group. Every round is staged. Nodes without an edge do not appear;
    null ends, loops and repeated edges are ignored."""
    now = stage(edges.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while (mark := _fingerprint(now)) != before:
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = (both.groupBy("u").agg(F.min("v").alias("m"))
                 .select("u", F.least("u", "m").alias("m")))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        large = stage(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e"))
                 .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct())
        now = stage(small, "edges")
    low = now.groupBy("u").agg(F.min("v").alias("component"))
    roots = low.select(F.col("component").alias("u"), "component").distinct()
    return low.unionByName(roots).select(F.col("u").alias("node"), "component")
