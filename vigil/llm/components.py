"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import table


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, component) per node of ``edges``; component is the smallest node reachable.

    Rounds run until the edge set no longer changes, without a round limit. Each round is written to the
    shared folder, so a lost executor costs one round. Two sums per round reach the driver. Null ends and loops
    are ignored; repeated and reversed edges count once; an empty table gives no row.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    e = table(e, "edges")
    before = _state(e)
    while before[0]:
        e = table(_small_star(_large_star(e)), "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    low = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return low.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _state(e: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    r = e.agg(F.count("*"), F.bit_xor(h), F.sum((h % 1_000_003).cast("long"))).first()
    return tuple(r)


def _large_star(e: DataFrame) -> DataFrame:
    """Each node points its larger neighbours at its smallest neighbour (itself included)."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node points itself and its smaller neighbours at the smallest of them; here all edges have u > v."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u != v").distinct()
