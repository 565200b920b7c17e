"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shuffled, stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of every node on its smallest neighbour: the larger ones, or the smaller ones and the node.

    The smallest neighbour is an aggregate and meets the links again in a join, so a node with very many links is
    neither collected nor confined to one task.
    """
    if large:
        links = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = links.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    met = links.join(shuffled(smallest), F.col("u") == F.col("node"))
    if large:
        hung = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            smallest.select(F.col("node").alias("u"), F.col("m").alias("v"))
        )
    return hung.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that each linked node can reach. Links have columns u and v (long, not null).

    Nodes without a link to another node are not listed. Each round is stored, so a lost executor repeats one round at
    most, and the number of rounds grows with the logarithm of the longest chain.
    """
    now = stored(links.filter("u <> v").select("u", "v").distinct())
    mark = None
    while True:
        next_ = stored(_star(_star(now, large=True), large=False))
        seen = next_.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        now = next_
        if seen == mark or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
