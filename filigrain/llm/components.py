"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filigrain.llm.common import split_join, written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node reachable.

    Edges (u, v), u > v, are written to the shared folder twice a round. Per-node minima are aggregated map-side first, and
    those of hubs are broadcast to their edges, so a hub's neighbours never meet in one task. The rounds end when only
    stars are left; each moves edges to smaller nodes until that is so."""
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while not _stars(e):
        # large star: every neighbour above u points to the smallest of u and its neighbours
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        low = written(low.select("u", F.least("u", "m").alias("m"), "n"), "lowest")
        e = written(split_join(both, low, ["u"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"), "edges")
        # small star: u and its smaller neighbours point to the smallest of them
        low = written(e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "lowest")
        joined = split_join(e, low, ["u"])
        e = written(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether every node of distinct edges (u, v) is the upper end of one edge at most, and then the lower end of none."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
    per = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not per.filter("up > 1 OR (up > 0 AND down > 0)").limit(1).count()
