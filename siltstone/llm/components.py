"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the smallest node of its component.

    Every round hangs the larger neighbours of a node, and then the smaller ones, on the smallest node around it; the number
    of rounds grows with the logarithm of a component's size. Minima are combined before the shuffle and joined back, so a
    node with very many links is spread by the skew join. Null ends and self links are left out; without links the result
    is empty.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("u", "n").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(hung).alias("e"))
        after = stored(small.select("e.*").where("u <> v").distinct(), "links")
        # done when every node hangs on one root, and no root hangs on another
        open_ = after.groupBy("u").count().where("count > 1").select("u").union(after.select("u").intersect(after.select("v")))
        edges = after
        if open_.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())
