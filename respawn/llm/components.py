"""Connected components of an edge table, as Spark jobs.

The large-star / small-star rounds of Kiveris et al., "Connected Components in MapReduce and
Beyond" (2014), run until no edge changes. A round joins each edge with the
minimum of its node's neighbourhood, so no neighbourhood is ever gathered in a task.
Each round's edges are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respawn.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half round over edges (a, b) with b < a; the result is of the same form."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    out = both.join(least, "a")
    if large:  # every larger neighbour joins the smallest
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # every smaller neighbour and the node itself join the smallest
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of 64-bit ids -> (node, root): root is the smallest id reachable.

    Only nodes with an edge to another node appear. Self-loops, repeated edges, either
    direction and edges with a null end (ignored) are allowed; no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    edges = stored(edges.distinct(), "edges")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
