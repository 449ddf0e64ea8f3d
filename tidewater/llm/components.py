"""Connected components of an edge table, by star contraction.

No vertex, edge or component list ever comes to the driver or meets in one
task: every step is an aggregation with partial minima and a join whose right
side has one row per key, so the centre of a large component is split by AQE.
Each round is checkpointed in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut


TASK_EDGES = 500_000  # edges that one task reads


def packed(edges: DataFrame, n: int) -> DataFrame:
    """Few edges are read by few tasks: a round of a nearly contracted graph costs little."""
    return edges.coalesce(max(1, -(-n // TASK_EDGES)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, c): for every vertex of ``edges`` the smallest vertex it reaches.
    Self-loops keep their vertex; an empty table gives an empty result."""
    both = cut(edges.select(F.least(a, b).alias("c"), F.greatest(a, b).alias("v")).distinct())
    n = both.count()
    e, sign = packed(both, n), None
    while n:
        # large star: every larger neighbour of u, and u itself, moves to u's smallest neighbour
        out = e.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("c").alias("w")),
                                         F.struct(F.col("c").alias("u"), F.col("v").alias("w")))).alias("x")).select("x.*")
        least = out.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m"))
        large = out.join(least, "u").where("w > u or m < u").select(
            F.explode(F.array(F.when(F.col("w") > F.col("u"), F.struct(F.col("w").alias("v"), F.col("m").alias("c"))),
                              F.when(F.col("m") < F.col("u"), F.struct(F.col("u").alias("v"), F.col("m").alias("c"))))).alias("x")
        ).where("x is not null").select("x.*").distinct()
        large = packed(cut(packed(large, 2 * n)), 2 * n)
        # small star: the smaller neighbours of v, and v, move to the smallest of them
        low = large.groupBy("v").agg(F.min("c").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(
            F.when(F.col("c") != F.col("m"), F.struct(F.col("c").alias("v"), F.col("m").alias("c"))),
            F.struct(F.col("v").alias("v"), F.col("m").alias("c")))).alias("x")).where("x is not null").select("x.*").distinct()
        e = cut(packed(small, 2 * n))
        n, mark = e.agg(F.count("*"), F.sum(F.xxhash64("v", "c").cast("decimal(38,0)"))).first()
        e = packed(e, n)
        if (n, mark) == sign:
            break
        sign = n, mark
    vertices = both.select(F.explode(F.array("v", "c")).alias("v")).distinct()
    if not n:
        return vertices.select("v", F.col("v").alias("c"))
    return vertices.join(e.select("v", "c"), "v", "left").select("v", F.coalesce("c", "v").alias("c"))
