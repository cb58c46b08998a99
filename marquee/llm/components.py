"""Connected components of an edge table by alternating stars.

Every step is a grouping (combined map-side) and a join; the edge table is written after each
round, so that lineage stays short and lost executors cost little. A vertex of very many edges
shrinks in the grouping, and the written tables let adaptive execution divide it in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written


def _least_neighbours(pairs: DataFrame) -> DataFrame:
    """Per vertex ``u`` the least of itself and its neighbours, as a written table."""
    least = written(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
    return least.select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each vertex's larger neighbours to the least of its neighbours and itself."""
    pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = pairs.join(_least_neighbours(pairs), "u").filter("v > u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect each vertex and its smaller neighbours to the least of these."""
    least = _least_neighbours(edges)
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every vertex is a centre, or has one edge to a centre."""
    end = lambda name, up: F.struct(F.col(name).alias("x"), F.lit(up).alias("up"))
    ends = F.explode(F.array(end("u", 1), end("v", 0)))
    vertices = edges.select(ends.alias("end")).select("end.*").groupBy("x")
    counted = vertices.agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return counted.filter("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def components(pairs: DataFrame) -> DataFrame:
    """``vertex`` and ``root``, its component's least vertex, for all ends of the pairs ``a``, ``b``.

    Edges point from the larger to the smaller end. Pairs with a null end or equal ends connect
    nothing; repeated pairs count once.
    """
    edges = written(
        pairs.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while not _are_stars(edges):
        edges = written(_small_star(written(_large_star(edges), "edges")), "edges")
    roots = edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    own = edges.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)
