"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node but the smallest of each component, which ``component`` names.

    Large-star joins a node's larger neighbours to its smallest one, small-star its
    smaller ones; both keep components and end in stars. Every round is written to the
    shared folder. Only counts come to the driver.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    stars = written(edges.filter(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "stars")
    state = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        stars = written(small.distinct(), "stars")
        new = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new == state:
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = new
