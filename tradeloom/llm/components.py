"""Connected components of a distributed graph, by alternating star contraction.

Every round hangs the larger neighbours of a node on its smallest neighbour, then the smaller ones;
after few rounds all nodes of a component hang on its smallest node.  Rounds are written to the
shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b`` long); the component is its smallest node."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
        # Larger neighbours go to the smallest node around.
        outward = both.join(least, F.col("a") == F.col("of")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        outward = stored(outward.where("a <> b").distinct(), "links")
        # Smaller neighbours and the node itself go to the smallest of them.
        down = outward.groupBy("a").agg(F.min("b").alias("m"))
        joined = outward.join(down.withColumnRenamed("a", "of"), F.col("a") == F.col("of"))
        inward = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        edges = stored(inward.where("a <> b").distinct(), "links")
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
