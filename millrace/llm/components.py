"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a``, ``b``).

    The component is its smallest node. Each round points every node at the smallest node next to
    it, follows those pointers eight steps, and contracts the graph along them; edges inside one
    contracted node go. The graph shrinks until no edge is left. Only counts reach the driver.
    Self-loops and repeated edges are allowed; an empty list gives no rows.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.distinct())
    labels = stored(edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")))
    while True:
        edges = edges.where("a <> b")
        if edges.isEmpty():
            return labels
        pointer = edges.groupBy("a").agg(F.min("b").alias("m"))
        pointer = stored(pointer.select(F.col("a").alias("node"), F.least("a", "m").alias("to")))
        for _ in range(3):
            onward = pointer.select(F.col("node").alias("to"), F.col("to").alias("then"))
            pointer = stored(
                pointer.join(onward, "to", "left").select("node", F.coalesce("then", "to").alias("to"))
            )
        to = pointer.select(F.col("node").alias("component"), "to")
        labels = stored(
            labels.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        )
        for end in ("a", "b"):
            to = pointer.select(F.col("node").alias(end), "to")
            other = "b" if end == "a" else "a"
            edges = edges.join(to, end, "left").select(F.coalesce("to", end).alias(end), other)
        edges = stored(edges.where("a <> b").distinct())
