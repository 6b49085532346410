"""Connected components by alternating stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut, drop


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node that can be reached.

    Edges point from the larger node to the smaller one. A round is a large-star (each end takes the least
    neighbour of the node it points to) and a small-star (all that a node points to, and the node itself,
    point to the least of them), as in Kiveris et al. 2014: it hooks whole trees to one another, so the rounds
    of a path grow with the logarithm of its length in any order of ids, and edges never become more. Rounds
    go on until nothing moves; there is no bound at which unsettled labels could leave. A hub with very many
    edges is pre-aggregated before its shuffle (min is partial); its join with that aggregate is not split by AQE,
    which does so only where both sides are shuffled for the join. Null ends,
    self-loops and repeated edges do nothing. Edges are written to the shared folder after each round.
    """
    one = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), F.col(a).alias("x"), F.col(b).alias("y"))
    down = cut(one.where("x IS NOT NULL AND y IS NOT NULL AND x <> y").select("hi", "lo").distinct(), "cc-edges")
    moved = True
    while moved:
        least = down.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("m"))
        large = down.join(least, "lo", "left").groupBy("hi", F.coalesce("m", "lo").alias("lo")).agg(F.max(F.col("m").isNotNull()).alias("moved"))
        small = large.join(large.groupBy("hi").agg(F.min("lo").alias("m")), "hi")
        ends = F.when(F.col("lo") == F.col("m"), F.array(F.struct("hi", "moved"))).otherwise(F.array(F.struct(F.col("lo").alias("hi"), F.lit(True).alias("moved")), F.struct("hi", "moved")))
        new = small.select("m", F.explode(ends).alias("e")).groupBy("e.hi", F.col("m").alias("lo")).agg(F.max("e.moved").alias("moved"))
        new = cut(new, "cc-edges")
        moved = not new.where("moved").isEmpty()
        drop(down)
        down = new
    labels = cut(down.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(down.select("lo", "lo").distinct()), "cc-labels")
    drop(down)
    return labels
