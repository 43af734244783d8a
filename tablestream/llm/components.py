"""Connected components of a table of links, by alternating star steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link; ``root`` is the smallest node of its component.

    ``links`` has two columns of ids. Each round hangs the larger neighbours of a node on its smallest neighbour (large star),
    then its smaller ones (small star); the number of rounds grows with the logarithm of the graph. Both steps aggregate the
    minimum before the shuffle, and the joins with that minimum may be split by AQE where one node has very many links.
    """
    a, b = links.columns
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges", few=True)
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(20,0)"))).first())
    seen = state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), "edges", few=True)
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
