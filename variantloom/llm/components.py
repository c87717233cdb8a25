"""Connected components of links between integer ids, by alternating stars; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import stage


def components(links: DataFrame, a: str, b: str, under: str | None = None) -> DataFrame:
    """``node, component`` for every id in a link: the smallest id it is connected with.

    Each round ties every node's larger neighbours, then its smaller ones, to its least neighbour. The number of links
    never grows and the rounds follow the logarithm of the longest path. A node of any degree is
    one row of minima, joined back to its links."""
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "component-links", under
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        larger = edges.select(F.col("v").alias("u"), F.col("u").alias("y")).join(least, "u")
        larger = larger.select(F.col("y").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        smallest = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(smallest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(smaller.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "component-links", under)
