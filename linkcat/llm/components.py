"""Connected components of links between ids, by alternating star contractions on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcat.session import durable


def components(links: DataFrame) -> DataFrame:
    """The smallest id that each linked id reaches: columns ``id``, ``component`` (ids that are the smallest themselves are left out).

    ``links`` has two columns of ids, in any order and with repeats. Every round hangs the larger neighbours of an id on
    its smallest neighbour and then the smaller ones, so the number of rounds grows with the logarithm of a component,
    whatever its shape. A neighbour list is never collected: rounds are minima and equi-joins.
    """
    a, b = links.columns
    links = durable(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = durable(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return links.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = now
