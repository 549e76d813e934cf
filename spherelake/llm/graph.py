"""Connected components of edges that no single machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spherelake.llm.common import cut, planned_once

#: The edges of a node are dealt out over so many keys when they meet its minimum.
SALTS = 8


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least v of their u.

    Minima are taken by node and salt first; a node has SALTS of them at most, so the
    window over a node is small, and the join back deals its edges out by the salt.
    """
    salted = edges.withColumn("s", F.pmod(F.col("v"), F.lit(SALTS)).cast("int"))
    part = salted.groupBy("u", "s").agg(F.min("v").alias("m"))
    return salted.join(part.select("u", "s", F.min("m").over(Window.partitionBy("u")).alias("m")).hint("merge"), ["u", "s"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the least of its neighbours and it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node, and its smaller neighbours, to the least of them.  Edges go from larger to smaller."""
    met = _with_least(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # An edge to the least links the node itself, any other edge its smaller neighbour.
    return met.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("a"), F.col("m").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge at most to a smaller one, and that one has none."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("to")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("to")))
    node = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("to").alias("to"))
    return node.where("out > 1 OR (out = 1 AND to = 1)").isEmpty()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(id, root) for every end of an edge (a, b); the root is the least id of its component.

    Alternates large and small stars until every edge leads to a root; the number of
    rounds grows with the logarithm of the nodes.  Each half round is a small plan of its
    own.  No edges give no rows.
    """
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    with planned_once(edges.sparkSession):
        for _ in range(most):
            if _settled(now):
                break
            now = cut(_small_star(cut(_large_star(now))))
        else:
            raise RuntimeError("components did not settle")
    own = now.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return own.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
