"""Connected components of a distributed edge list.

Alternates the large-star and small-star steps until every node has a single edge
to the smallest node of its component. Each round is written to the shared folder,
which cuts the lineage; nothing but a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panewise.llm.common import drop_written, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the two long columns of ``edges``; component is the smallest reachable node.

    Loops, repeated edges and nulls may occur; a node with nothing but loops is its own component.
    """
    a, b = edges.columns
    every = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    now = written(every.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    loops = now.filter("u = v").select("u", "v")
    before = None
    while True:
        links = now.filter("u <> v")
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        rooted = low.filter("m < u").select("u", F.col("m").alias("v"))
        large = large.union(rooted).filter("u <> v")  # repeats go with the last step
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        # done once every node has one edge and its smaller end has none
        ends = after.select(F.col("u").alias("node"), F.lit(1).alias("k")).union(after.select("v", F.lit(0)))
        open_ends = ends.groupBy("node").agg(F.sum("k").alias("k"), F.min("k").alias("low")).filter("k > 1 OR (k = 1 AND low = 0)").count()
        if before is not None:
            drop_written(before)
        before, now = after, after
        if not open_ends:
            break
    own = now.select(F.col("v").alias("node"), F.col("v").alias("component")).union(loops.select("u", "v"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own).groupBy("node").agg(F.min("component").alias("component"))
