"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import kept


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour (the larger ones, or the smaller ones and the node
    itself) to the node's least neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with a link; ``links`` has long columns a
    and b. The root is the component's least node."""
    state = None
    links = kept(links.filter("a <> b").select("a", "b").distinct())
    for _ in range(most_rounds):
        links = kept(_stars(kept(_stars(links, True)), False))
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = seen
    raise RuntimeError("components did not settle")
