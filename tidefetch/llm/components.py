"""Connected components of a table of links, without bringing them to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefetch.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node of each node's component, for the nodes of ``links`` (a, b).

    Every round links each node and its neighbours to the least of them, first from the side
    of the larger nodes, then of the smaller ones. The number of rounds grows with the
    logarithm of the longest chain. Roots are then at the end of every link.
    """
    edges = settle(_ordered(links), "edges")
    seen = None
    while True:
        large = _star(edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low"))), False)
        edges = settle(_star(large, True), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.where("a != b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct()
    )


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Links every neighbour of a node to the least node around it.

    Large: ``edges`` lead both ways, and only larger neighbours are linked anew. Small: they
    lead from the larger node to smaller ones, and the node itself is linked too. The least
    is grouped first and joined back, so the neighbours of one node need not meet in a task.
    """
    least = edges.groupBy("high").agg(F.min("low").alias("m")).withColumn("m", F.least("m", "high"))
    around = edges.join(least, "high")
    if small:
        out = around.select(F.col("low").alias("x"), "m").unionByName(least.select(F.col("high").alias("x"), "m"))
    else:
        out = around.where("low > high").select(F.col("low").alias("x"), "m")
    return out.where("x != m").select(F.col("x").alias("high"), F.col("m").alias("low")).distinct()
