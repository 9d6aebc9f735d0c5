"""Connected components of an edge table by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avmatch.llm.store import stash


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point down (u > v): a node's lower neighbours and the node itself move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (u, v): component is the smallest node reachable.

    Edges may repeat and point either way; loops and nulls are ignored; an empty table gives an empty table. Each
    round is written to the shared folder, and only its row count and checksum reach the driver.
    """
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    down = stash(down, "edges")
    mark = None
    while True:
        now = down.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == mark or not now[0]:
            break
        mark = now
        down = stash(_small_star(_large_star(down)), "edges")
    roots = down.select(F.col("v").alias("node")).distinct()
    return down.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
