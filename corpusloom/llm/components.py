"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _joined_to_least(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)`` that is not its own root;
    ``root`` is the smallest node of the component.

    Each round is two group-bys and joins over the edges, which shrink to one star
    per component; a round is cut off with a reliable checkpoint. Edges are never
    collected: the driver reads a count and a checksum.
    """
    e = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .distinct().checkpoint())
    seen = None
    for _ in range(max_rounds):
        state = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if not state["n"] or (state["n"], state["x"]) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = (state["n"], state["x"])
        # large star: larger neighbours move to the least of the neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_joined_to_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
                 .distinct())
        # small star: smaller neighbours and the node itself move to the least of them
        small = _joined_to_least(large)
        e = (small.select("u", F.col("m").alias("v"))
             .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
             .distinct().checkpoint())
    raise RuntimeError("components did not settle")
