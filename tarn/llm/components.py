"""Connected components of a graph too large for one machine, by alternating star contractions.

Each round hangs every vertex's larger neighbours, then its smaller ones, on its smallest neighbour. Rounds are cut into
the shared folder. Degrees may be as large as the graph: minima are aggregated before the shuffle, and a vertex's edges
meet its minimum in a join of two stored tables, which Spark may split where a vertex is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop

MAX_ROUNDS = 60


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of edges (u, v), u and v of one ordered type; component is its smallest vertex.

    Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = _sum(edges)
    for _ in range(MAX_ROUNDS):
        both = cut(_both(edges), "both")
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        # large star: larger neighbours to the minimum
        large = cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        drop(both, least, edges)
        # small star: the smaller neighbours, and the vertex itself
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = cut(moved, "edges")
        drop(large, least)
        now = _sum(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())


def _sum(edges: DataFrame):
    """Equal for equal sets of edges, and hardly for others."""
    return edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
