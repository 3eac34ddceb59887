"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import settle


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for every node with a partner in `links` (columns a, b); root is the least node.

    Each round hangs the larger neighbours, then the smaller ones, on the least node known. Minima
    are aggregates with map-side combining, written before they are joined, so that the joins'
    sides are plain shuffles which can be split at a hot node; no neighbour list is ever collected. Every round is written to the shared folder. Rounds grow with the
    logarithm of a component's size. An empty table gives an empty table; loops (a = b) and links with
    a null end are left out.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, before = settle(links.distinct(), "links"), None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large_least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = settle(large, "large_star")
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")), "small_least")
        small = large.join(least, "u")
        edges = settle(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "small_star",
        )
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(tops)
