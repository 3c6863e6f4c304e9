"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import discard, hub_join, keep


def _nearest(edges: DataFrame, name: str) -> DataFrame:
    """Smallest neighbour and number of links of each u; they combine before the shuffle, so a hub is no hot task."""
    return keep(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n_rows")), name)


def components(edges: DataFrame) -> DataFrame:
    """u, v of links in either direction -> node, root: the smallest node that each node reaches.

    Large-star and small-star steps in turn: each links neighbours to their
    smallest common neighbour, until a round changes nothing; the rounds grow as
    the logarithm of the longest path. The links of a hub are not gathered in one
    task: hubs are few and joined by a broadcast (hub_join). Self-links, repeated
    links and links in both directions do no harm; links with a null end are
    ignored. Nodes without a link are not returned.
    """
    down = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = keep(edges.where("u <> v").select(*down).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _nearest(both, "large-least")
        joined = hub_join(both.where("v > u"), least.withColumn("m", F.least("u", "m")), "u")
        large = keep(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large-star")
        discard(edges, least)
        least = _nearest(large, "small-least")
        small = hub_join(large, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = keep(small.where("u <> v").select(*down).distinct(), "small-star")
        discard(large, least)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = now
