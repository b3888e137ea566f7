"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"] or 0


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): component is its smallest node.

    Each round hooks larger neighbours to the smallest one (large star), then
    does so among smaller ones (small star); both are a min per node and a join,
    so a hub's neighbours are never gathered in one place. Each round is written
    to shared storage. Self-links, repeats and null ends are ignored; an empty
    table gives an empty result.
    """
    e = (edges.where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = stored(e, "edges")
    before = _state(e)
    if not before[0]:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select("u", F.col("m").alias("v"))
                 .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .distinct())
        e = stored(small, "edges")
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    own = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
