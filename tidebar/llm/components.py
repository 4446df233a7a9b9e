"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def components(links: DataFrame) -> DataFrame:
    """links (a, b), both long and not null, to (node, label): each linked node with the smallest of its component.

    Union-find as tables: large-star hangs all larger neighbours of a node on the smallest of its
    neighbourhood, small-star all smaller ones, until every node hangs on its component's smallest. Each
    step is a group-by for the minima, aggregated before the shuffle, and a join that brings them back; a
    node of many links is no special case. Steps are cut, so a lost executor repeats one step at most.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small_least, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_least.select("u", F.col("m").alias("v")))
        new = cut(small.where("u <> v").distinct(), "links")
        state = new.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        drop(edges)
        edges = new
        if state == before:
            break
        before = state
    stars = edges.groupBy("u").agg(F.min("v").alias("label"))
    return stars.select(F.col("u").alias("node"), "label").unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
