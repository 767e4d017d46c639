"""Connected components of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import checkpointed


#: links that a partition of the small tables of a round has
ROWS_PER_PART = 100_000


def components(links: DataFrame) -> DataFrame:
    """The smallest node of the component of every linked node: node, root.

    ``links`` has two columns of numbers, in any direction. Each round hangs larger neighbours on a node's
    smallest neighbour, then smaller ones too, until every node hangs on the smallest of its component; the
    number of rounds is logarithmic in the size of a component, and each cuts its lineage. No node's neighbours
    are gathered: a round is a minimum by node and a join. Rounds run on as many partitions as the links need.
    """
    a, b = links.columns
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    edges = checkpointed(edges.distinct())
    parts = 1 + edges.count() // ROWS_PER_PART
    while True:
        # every node with all neighbours: larger ones move to its smallest neighbour (or itself)
        edges = edges.coalesce(parts)
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        ).coalesce(parts)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = moved.coalesce(parts).distinct().coalesce(parts)
        # smaller neighbours, and the node, move to its smallest neighbour
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi").select(F.col("lo").alias("u"), "m").filter("u != m")
        small = moved.unionAll(least.select(F.col("hi").alias("u"), "m")).coalesce(parts).distinct().coalesce(parts)
        edges = checkpointed(small.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
        n, nodes = edges.agg(F.count(F.lit(1)), F.countDistinct("hi")).first()
        if n == nodes and edges.join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi").isEmpty():
            # every node hangs on one other, and none of those on a further one
            roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            return roots.unionAll(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
