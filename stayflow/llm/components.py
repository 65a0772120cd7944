"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import stored


def stored_edges(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and their number and sum of hashes, which the write counts as it goes."""
    seen = Observation()
    hashes = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    kept = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), hashes.alias("hashes")), "component-edges")
    found = seen.get  # nothing is observed where the plan turns out to be empty
    return kept, (found.get("n", 0), found.get("hashes"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is named by its smallest node.

    Every step is a grouped minimum (combined before the shuffle) and a join that adaptive execution can split, so a node
    with very many neighbours is no hot spot. Each round is written to the shared folder.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stored_edges(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges, now = stored_edges(small)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
