"""Connected components of a table of edges, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import discard, staged


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge that is not its component's least node, the root.

    Alternates large and small stars: all larger neighbours of a node, then all smaller ones, are
    linked to the least of them, until nothing changes. A round needs only the least neighbour per
    node, which is counted with map-side aggregation. Loops and nulls are left out.
    """
    start = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = staged(start.filter((F.col("u") != F.col("v")) & edges[a].isNotNull() & edges[b].isNotNull()).distinct(), "edges")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(low, both.u == low.w).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        moved = large.join(low, large.u == low.w).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs, replaced = staged(moved.union(low.select("w", "m")).distinct().toDF("u", "v"), "edges"), pairs
        discard(replaced)
        after = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if after == before or not after[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
