"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed_join, materialize


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node it can reach.

    Each round lowers every node's neighbours to the smallest one (large star) and then ties
    them under it (small star); the rounds grow with the logarithm of the longest chain.  Minima
    are aggregated before the shuffle, and come to the links of a hub by broadcast, so one with very many links makes no large task.
    Self links and repeated links are allowed, links with a null end are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v and v is not null and u is not null").distinct()
    edges = materialize(edges)
    before = None
    while (now := _digest(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")).select("u", F.least("u", "m").alias("m"), "c"))
        large = keyed_join(both, low, ["u"], "c", 2 * now[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = materialize(large)
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")))
        tied = keyed_join(large, low, ["u"], "c", now[0])
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u > v").distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
