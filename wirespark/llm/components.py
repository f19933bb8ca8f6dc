"""Connected components of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirespark.llm.common import stored
from wirespark.operators.joins import lookup_join


def _least_neighbour(links: DataFrame) -> DataFrame:
    """Each link (u, v) with the least of u and all its neighbours.

    Aggregated and joined back rather than ranked in a window: a node that most links share
    is summed up per task first, and its rows in the join can be split.
    """
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return lookup_join(links, least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = _least_neighbour(both).filter("v > u")
    return met.select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    met = _least_neighbour(links)
    own = met.select("u", F.col("least").alias("v"))
    return own.union(met.select(F.col("v").alias("u"), F.col("least").alias("v")))


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """Nodes of the links ``a``, ``b`` with the least node reachable from each.

    Rounds of large and small stars (Kiveris et al., 2014) until nothing changes; their number
    grows with the logarithm of the size. Each round is written to the shared folder. Returns
    node, root; nodes without a link to another node are left out.
    """
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = stored(now.filter("u > v").distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = mark
        large = _large_star(now).filter("u > v").distinct()
        now = stored(_small_star(large).filter("u > v").distinct(), "links")
