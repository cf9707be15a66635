"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour."""
    both = links.union(links.select("small", "large")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (
        both.join(least, "node")
        .where(F.col("other") > F.col("node"))
        .select(F.col("other").alias("large"), F.col("least").alias("small"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Tie the smaller neighbours of a node, and the node, to the smallest of them."""
    least = links.groupBy("large").agg(F.min("small").alias("least"))
    moved = (
        links.join(least, "large")
        .where(F.col("small") > F.col("least"))
        .select(F.col("small").alias("large"), F.col("least").alias("small"))
    )
    return moved.union(least.toDF("large", "small")).distinct()


def _digest(links: DataFrame) -> tuple:
    """Same for the same set of links, whatever their order."""
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.sum((F.xxhash64("large", "small") % 1_000_003).cast("long")),
            F.sum((F.xxhash64("small", "large") % 998_244_353).cast("long")),
        ).first()
    )


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``root`` for every node of a link; root is the smallest node reachable.

    ``left`` and ``right`` name long columns of ``links``. Repeated, reversed and
    self links are allowed; a node that only links to itself, and an empty table,
    give no rows. The driver sees three numbers per round. Rounds grow with the
    logarithm of a component's size, and each is a stored table.
    """
    current = stored(
        links.where(F.col(left) != F.col(right))
        .select(
            F.greatest(left, right).alias("large"), F.least(left, right).alias("small")
        )
        .distinct(),
        "links",
    )
    before = _digest(current)
    while True:
        current = stored(_small_star(_large_star(current)), "links")
        after = _digest(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("small").alias("node"), F.col("small").alias("root"))
    return current.toDF("node", "root").union(roots.distinct())
