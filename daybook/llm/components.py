"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.session import materialise

MOST_ROUNDS = 100


def _least(pairs: DataFrame) -> DataFrame:
    """For every node u the least of itself and its neighbours v."""
    return pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Ties every greater neighbour of a node to the least node around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_least(both), "u").filter("v > u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the least of them; links point to the smaller node."""
    least = _least(links)
    tied = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.min("u"), F.max("v")).first())


def components(links: DataFrame) -> DataFrame:
    """node and root, the least node of its component, for every node with a link to another.

    ``links`` has the long columns u and v in any order; loops and repeated links do no harm. Stars
    around large and small neighbours alternate, which halves the depth of a component in each round,
    until every component is one star. Each round is written to the shared folder, so lineage stays
    short and lost executors cost one round at most. A hub's links are joined, not gathered.
    """
    links = links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = materialise(links, "links")
    before = _signature(links)
    for _ in range(MOST_ROUNDS):
        links = materialise(_small_star(_large_star(links)), "stars")
        now = _signature(links)
        if now == before:
            roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = now
    raise RuntimeError(f"components did not settle within {MOST_ROUNDS} rounds")
