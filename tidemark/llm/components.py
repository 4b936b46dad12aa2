"""Connected components of a stored edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One round. Each node's smallest neighbour (or itself) becomes the centre of its neighbours:
    of the larger ones in a large star, of the smaller ones and itself in a small star."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    side = both if large else both.filter(F.col("v") < F.col("u"))
    centre = side.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = side.join(centre, "u")
    if large:
        moved = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            centre.select("u", F.col("m").alias("v"))
        )
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of ``edges`` (u, v) that is not the smallest of its component.

    Every round is a few joins and aggregations over the edges alone and is stored, so lost executors
    cost one round; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = store(edges.filter(F.col("u") != F.col("v")).distinct(), "edges")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    now = mark(edges)
    while now[0]:
        following = store(star(star(edges, large=True), large=False), "edges")
        after = mark(following)
        if after == now:
            break
        edges, now = following, after
    return edges.select("u", F.col("v").alias("root"))
