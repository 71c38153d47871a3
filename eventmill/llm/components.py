"""Connected components of a link table, by contraction.

Each level points every node at its smallest neighbour (or itself) and replaces
both ends of every link by that. A level at least halves the nodes that still
have links, so the levels are few however long the chains are. Per-node work is
a partial aggregation and joins on the node, so a node with a third of all
links is split by Spark like any other hot join key; nothing reaches the driver
but the number of links left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; ``links`` has long columns a and b.

    ``component`` is the smallest node that can be reached. Self-links, missing
    ends and repeated links change nothing; no links give an empty table.
    """
    left = written(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    levels = []
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("parent")), "parents")
        levels.append(parents)
        ends = left.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a").join(
            parents.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
        left = written(ends.where("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
    if not levels:
        return links.sparkSession.createDataFrame([], "node long, component long")
    found = levels[-1].withColumnRenamed("parent", "component")
    for parents in reversed(levels[:-1]):  # a node's parent may have no link on the next level: then it is the component
        above = found.select(F.col("node").alias("parent"), "component")
        found = written(parents.join(above, "parent", "left").select("node", F.coalesce("component", "parent").alias("component")), "components")
    return found
