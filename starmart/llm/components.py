"""Connected components of a link table, by alternating large and small stars.

Each round links every node to the smallest node around it; no group of neighbours is
ever gathered, and a node with very many neighbours costs one combined minimum and one
join. Rounds end when only stars are left, after about the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import written

# Links that make a file.
LINKS = 250_000


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node now links to the smallest node around it."""
    both = links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
    return (
        both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours now link to the smallest of them."""
    least = links.groupBy("x").agg(F.min("y").alias("m"))
    # Both ends of a link from one join: used twice, the minimum would be computed twice.
    ends = F.explode(F.array("x", "y")).alias("x")
    return links.join(least, "x").select(ends, F.col("m").alias("y")).filter("x != y")


def _count(links: DataFrame, parts: int | None) -> tuple[int, int]:
    """The links, and the nodes that have more than one to a smaller node, or one to a node
    that has one itself.
    """
    down = links.select(F.col("x").alias("node"), F.lit(1).alias("smaller"))
    up = links.select(F.col("y").alias("node"), F.lit(0).alias("smaller"))
    nodes = down.unionAll(up).groupBy("node").agg(
        F.sum("smaller").alias("links"), F.min("smaller").alias("only")
    )
    nodes = nodes.coalesce(parts) if parts else nodes
    unsettled = (F.col("links") > 1) | (F.col("links") > F.col("only"))
    total = F.coalesce(F.sum("links"), F.lit(0))
    return tuple(nodes.agg(total, F.count_if(unsettled)).first())


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every linked node but the smallest.

    ``links`` has long columns x and y; either may be the larger. A round writes as many
    files as its links ask for, not one for each shuffle partition.
    """
    now = links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    now = written(now.filter("x != y").distinct(), "links")
    count, unsettled = _count(now, None)
    parts = max(links.sparkSession.sparkContext.defaultParallelism, -(-count // LINKS))
    while unsettled:
        star = _small_star(_large_star(now).distinct()).distinct()
        now = written(star.coalesce(parts), "links")
        unsettled = _count(now, parts)[1]
    return now.select(F.col("x").alias("node"), F.col("y").alias("component"))
