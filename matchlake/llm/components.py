"""Connected components of a graph given by its links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.scratch import cut, discard


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id in links (a, b: bigint).

    Each step rewires nodes to the smallest of their neighbours and is written to the shared folder; the
    tables of the step before are emptied. The number of steps grows with the logarithm of the number of links. No links give no rows.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written first, so that the join with a node of very many links is a skewed join that Spark can split.
        nearest = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stepped = cut(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(edges, nearest)
        edges = stepped
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    out = cut(stars.union(edges.select("v", "v").distinct()), "components")
    discard(edges)
    return out
