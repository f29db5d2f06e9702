"""Connected components by large-star and small-star rounds.

Each round replaces the neighbours of a node by links to its smallest neighbour.
Minima are aggregated before the shuffle and looked up by plain joins between stored
tables, which adaptive execution can split, so a hub with a third of all links is no
single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import stored


def _linked(links: DataFrame, both: bool) -> DataFrame:
    pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        pairs = pairs.union(links.select("b", "a"))
    least = stored(
        pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least"
    )
    found = pairs.join(least, "u")
    if both:
        return found.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b")
    return found.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
        least.select("u", "m")
    ).where("a != b")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for all nodes in ``a`` or ``b``: root is the smallest node reachable."""
    ordered = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(),
        "links",
    )
    before = None
    while (state := _state(ordered)) != before:
        before = state
        large = stored(_linked(ordered, both=True).distinct(), "large-star")
        ordered = stored(_linked(large, both=False).distinct(), "small-star")
    roots = ordered.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(ordered.select("b", "b").distinct())
