"""Connected components of links between numbered rows, as a few joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import discard, store

# Links per file of the stored state: a few megabytes.
ROWS_PER_FILE = 50_000
# Up to this many links the minima per node are broadcast, and the rows of a hot node stay where they are.
BROADCAST_ROWS = 100_000


def _down(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller end."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node but the roots has one link, to a root."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    ends = ends.unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    per_node = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return per_node.where("up > 1 or (up = 1 and root = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every end of a link (columns u, v); root is the smallest node reachable.

    Alternates two star steps until all components are stars. Large star: every larger neighbour
    of a node is linked to the node's smallest neighbour. Small star: the smaller neighbours, and
    the node, are linked to the smallest of them. Rounds grow with the logarithm of the longest
    path. The state between rounds is one stored table of at most as many rows as links; minima
    combine before they shuffle, and the joins are inner, so Spark can split hot nodes.
    """
    edges = store(_down(links), "links")
    while not _are_stars(edges):
        size = edges.count()

        def minima(side: DataFrame, small: bool = size <= BROADCAST_ROWS) -> DataFrame:
            return F.broadcast(side) if small else side

        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(minima(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(minima(lowest), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = _down(small.unionByName(lowest.select("u", F.col("m").alias("v"))))
        # No more rows than before come out, so this many files hold them.
        files = 1 + size // ROWS_PER_FILE
        after = store(after.coalesce(files), "links")
        discard(edges)
        edges = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
