"""Connected components of a graph given as a frame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``v``, ``root`` for every vertex of ``edges`` (``u``, ``v``, longs): the root is the
    smallest vertex that can be reached.

    Rounds of contraction: every vertex points at its smallest neighbour, pointers are
    doubled until they reach a root, and edges are redrawn between roots, until none is
    left. The number of rounds grows with the logarithm of the graph. Each step is a
    map-side combined minimum or a join; nothing is collected.
    """
    edges = materialize(edges.filter(F.col("u") != F.col("v")).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    roots = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pointers = materialize(both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("p"))
                               .select("v", F.least("v", "p").alias("root")))
        while True:
            up = pointers.select(F.col("v").alias("root"), F.col("root").alias("next"))
            jumped = materialize(pointers.join(up, "root", "left").select(
                "v", F.coalesce("next", "root").alias("root"), (F.col("next") < F.col("root")).alias("moved")))
            moved = jumped.filter("moved").limit(1).count()
            pointers = jumped.drop("moved")
            if not moved:
                break
        if roots is None:
            roots = pointers
        else:
            up = pointers.select(F.col("v").alias("root"), F.col("root").alias("next"))
            roots = roots.join(up, "root", "left").select("v", F.coalesce("next", "root").alias("root"))
        to = lambda name: pointers.select(F.col("v").alias(name), F.col("root").alias(f"{name}_root"))
        edges = materialize(edges.join(to("u"), "u").join(to("v"), "v")
                            .select(F.least("u_root", "v_root").alias("u"), F.greatest("u_root", "v_root").alias("v"))
                            .filter(F.col("u") != F.col("v")).distinct())
        if edges.limit(1).count() == 0:
            return materialize(roots)
