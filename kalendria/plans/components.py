"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendria.plans import scratch


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): the least id of its component for every end of an edge.

    Least labels travel along edges and then jump to their own labels, until a
    round moves none; each round is one table in the shared folder, and the one
    before it goes. ``edges`` is read twice.
    """
    one = edges.select(F.col(a).alias("id"), F.col(b).alias("to"))
    n = 2 * edges.count()
    both = scratch.table(one.unionByName(one.select(F.col("to").alias("id"), F.col("id").alias("to"))).distinct(), n)
    stored = scratch.table(both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("root")), n)
    labels = stored
    while True:
        seen = both.join(labels.withColumnRenamed("id", "to"), "to").groupBy("id").agg(F.min("root").alias("m"))
        low = labels.join(seen, "id").select("id", "root", F.least("root", "m").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("root").alias("far"))
        step = scratch.table(low.join(jump, "low", "left").select("id", F.least("low", F.coalesce("far", "low")).alias("new"), "root"), n)
        moved = step.filter(F.col("new") < F.col("root")).limit(1).count()
        scratch.drop(stored)
        stored = step
        labels = step.select("id", F.col("new").alias("root"))
        if not moved:
            scratch.drop(both)
            return labels
