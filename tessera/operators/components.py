"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.state import scoped, staged, unstaged

#: Edges of a written partition, about, and fewest partitions: many rounds over few edges write few files.
PART_EDGES, LEAST_PARTS = 100_000, 12


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (columns a, b of one orderable type); root is the smallest node reached.

    Edges with a null end and loops are left out, so a node that has only such is not in the result. Each round
    aggregates neighbours before it joins, so a node with very many edges is summed on the map side and its join is one
    that Spark can split; every round is written to the shared folder, and the one before is deleted then. No component
    is ever held in one place. The number of rounds grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    edge = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edge, seen = staged(edge), None
    while True:
        now = edge.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen or not now["n"]:
            return edge.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edge.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen, parts = now, max(LEAST_PARTS, now["n"] // PART_EDGES)
        with scoped(spark) as scope:
            both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            large = staged(large.coalesce(parts))
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            new = scope.keep(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().coalesce(parts))
        unstaged(edge)
        edge = new
