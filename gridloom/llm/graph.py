"""Connected components by contraction, with all state in stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.core.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node in ``edges`` (a, b: long).

    Each round sends a node to the least node beside it, follows that pointer once more, and
    replaces edges by those between targets, until none is left.  Hubs only meet aggregates
    with partial results and joins that can be split.
    """
    edges = cut_lineage(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    )
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = ends.withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.select(F.col("b").alias("node"), F.col("a").alias("to")).union(edges.select("a", "a"))
        step = both.groupBy("node").agg(F.min("to").alias("to"))
        jump = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
        target = cut_lineage(step.join(jump, "to").select("node", F.col("further").alias("to")))

        def moved(df: DataFrame, column: str) -> DataFrame:
            to = target.select(F.col("node").alias(column), F.col("to").alias("_to"))  # noqa: B023
            return df.join(to, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")

        labels = moved(labels, "component")
        edges = moved(moved(edges, "a"), "b").where("a <> b")
        edges = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return cut_lineage(labels)
