"""Connected parts of a graph given as a table of edges, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b of type long); nodes of one part share the root.

    In each round a node joins the one with the smallest hash among itself and
    its neighbours, the hash differing from round to round, and edges are
    redrawn between what nodes have joined.  That shrinks any graph, long
    chains too, by a constant factor a round.  Neighbours are reduced by a
    minimum, so a node with very many edges is added up before rows move;
    rounds are cut by tables in the shared folder.
    """
    left = written(edges.filter("a <> b").select("a", "b"), "edges")
    steps: list[DataFrame] = []
    while not left.isEmpty():
        mark = lambda c, n=len(steps): F.struct(F.xxhash64(F.lit(n), c).alias("hash"), F.col(c).alias("node"))
        both = left.union(left.select("b", "a"))
        near = both.groupBy("a").agg(F.min(mark("b")).alias("best"))
        step = written(near.select(F.col("a").alias("node"), F.least(F.col("best"), mark("a"))["node"].alias("root")), "roots")
        steps.append(step)
        to_a, to_b = (step.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b"))
        redrawn = left.join(to_a, "a").join(to_b, "b").filter("a_root <> b_root")
        left = written(
            redrawn.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "edges"
        )
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("later"))
        found = found.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return found
