"""Connected components over an edge table of any size, with DataFrame joins only.

Edges are rewritten until every component is a star around its smallest node: in turn each node's
larger neighbours are linked to the smallest neighbour, then its smaller ones. A round is two
aggregates (``min``, combined map-side) and two joins with one match a row on the right, so a node
with a third of all edges is split by Spark's skew join. The number of rounds grows with the
logarithm of the longest chain. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node: links a node and its smaller
    neighbours to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots themselves: the smallest node
    of its component. Null ends and loops are ignored; an empty table gives no rows."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.col("a").isNotNull().alias("x"), F.col("b").isNotNull().alias("y"))
                 .filter("x and y and a != b").select("a", "b").distinct())
    before = _digest(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)))
        after = _digest(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
