"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetflow.llm.common import cut


def _nearest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def connected(edges: DataFrame) -> DataFrame:
    """(u, v) for every node u that is not the least of its component, v being the least. Input: edges (u, v).

    Every round joins each node's neighbours to its least one; rounds grow with the logarithm of a component's
    length. A node's neighbours are never gathered: the least is a partial aggregate, and the join back is on rows
    that adaptive execution may split. Rounds go on until none changes anything, each kept in the shared folder.
    """
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_nearest(both), "u").where("v > u").select(
            F.col("v").alias("u"), F.least("u", "least").alias("v")
        ).distinct()
        near = large.join(_nearest(large), "u")
        small = near.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = cut(small.unionByName(near.select("u", F.col("least").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges
        before = now
