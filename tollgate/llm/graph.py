"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so no component is ever collected
in one place; each step's edges are written to the shared folder, which also
cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tollgate.llm.staging import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and a digest of them from the same job."""
    seen = Observation()
    digest = (F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
    table = materialise(edges.observe(seen, *digest), "edges")
    return table, (seen.get["n"], seen.get["x"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) links -> (node, component): the smallest node that is reachable.

    Only nodes with a link to another node are returned; loops, repeated and
    reversed links do not matter, and no links give an empty result.
    """
    now, state = _written(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while state[0]:
        # large star keeps u > v, which small star expects
        before = state
        now, state = _written(_small_star(_large_star(now)))
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
