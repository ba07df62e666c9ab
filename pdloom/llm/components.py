"""Connected components by alternating large and small stars, each step a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pdloom.llm.common import discard, stored


def _checksum(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of a node to the smallest among it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node and component (the smallest node reachable) for every node of an edge.

    Loops, repeated edges and edges with a null end change nothing; no edge gives no row. A node
    with very many edges is summed on the map side and its join dealt out as a skewed one.
    """
    current = stored(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "components",
    )
    seen = _checksum(current)
    while seen[0]:
        fresh = stored(_small_star(_large_star(current)), "components")
        now = _checksum(fresh)
        discard(current)
        current = fresh
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("u")).distinct()
    return current.unionByName(roots.select("u", F.col("u").alias("v"))).toDF("node", "component")
