"""Connected components over a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """(a long, b long) links -> (node, root): every linked node and the least node it reaches.

    Alternates large-star and small-star steps, each a pre-aggregated minimum per node and a join, until
    the links stop changing; hubs only ever meet partial minima, never lists of neighbours. Each round
    is written to the shared checkpoint folder, so lineage stays short.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = keep(edges)
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = keep(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    rooted = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
