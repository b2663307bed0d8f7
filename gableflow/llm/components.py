"""Connected components over links between numbers, by alternating large and small stars.

Each round is two joins on written tables, so Spark may split a hub's rows over tasks, and ends at files in the shared
folder. Nothing of the graph comes to the driver but two numbers a round that tell whether the links still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def connected(links: DataFrame) -> DataFrame:
    """links (u long, v long), in any direction, repeated or not -> (node, root): every linked node that is not its component's least, with that least.

    Rounds end when no link is new and none has gone. What a round leaves behind is deleted.
    """
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    n = edges.count()
    while n:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large-star")
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        lower = written(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(least, large, lower)
        before, n = n, after.count()
        same = n == before and not after.join(edges, ["u", "v"], "left_anti").limit(1).count()
        discard(edges)
        edges = after
        if same:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
