"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """From links ``a``, ``b`` (longs), the ``root`` of each linked ``node``: nodes are connected exactly if their roots are equal.

    Each round every node points to that of its neighbours and itself which comes first in an order by hash, drawn anew for each round; then
    links join what is pointed to, and links within one are dropped. So the graph shrinks by a constant factor a round, also a long path or a
    star, and no list of neighbours is ever gathered: pointing is a minimum. Each round is written to the shared folder.
    """
    both = links.where("a != b").select("a", "b").distinct()
    edges = staged(both, "links")
    steps = []
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(steps)), c).alias("rank"), F.col(c).alias("node"))  # noqa: E731, B023
        ends = edges.select(F.col("a").alias("node"), rank("b").alias("near")).unionByName(edges.select(F.col("b").alias("node"), rank("a").alias("near")))
        near = ends.groupBy("node").agg(F.min("near").alias("near"))
        points = staged(near.select("node", F.least(F.col("near"), rank("node"))["node"].alias("to")), "points")
        steps.append(points)
        a, b = (points.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in ("a", "b"))
        moved = edges.join(a, "a").join(b, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = staged(moved.where("a != b").distinct(), "links")
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    roots = steps[-1].select("node", F.col("to").alias("root"))
    for points in reversed(steps[:-1]):
        after = roots.select(F.col("node").alias("to"), "root")
        roots = staged(points.join(after, "to", "left").select("node", F.coalesce("root", "to").alias("root")), "roots")
    return roots
