"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.staging import stage


def _with_least(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` of every node in ``links(u, v)``; a component is named by its least node.

    Each round lets every node point its larger neighbours to its least one, then its smaller ones. Links
    only ever move towards the least node of their component, so the rounds are about the logarithm of
    the longest chain. Rounds are written to the shared folder, so the lineage stays short.
    """
    both = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = stage(both, "links"), None
    for _ in range(rounds):
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(around).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        small = _with_least(large)
        small = small.select("m", F.explode(F.array("u", "v")).alias("node"))
        small = small.select(F.col("node").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        edges = stage(small, "links")
        facts = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(xxhash64(v, u) as decimal(38, 0)))")).first()
        if facts == before:
            break
        before = facts
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
