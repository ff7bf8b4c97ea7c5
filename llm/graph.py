"""Connected components of an edge table, by contraction. Nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tables import saved


def components(edges: DataFrame) -> DataFrame:
    """(v long, label long): the smallest vertex that each vertex of ``edges`` (a long, b long) can reach.

    Each round gives every vertex the smallest neighbour (or itself) as parent, follows the parents to
    their parents, and contracts the edges to parents; rounds end when no edge joins two parents.
    Vertices without an edge do not appear.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels, left = None, saved(both.filter("a <> b").distinct())
    while left.take(1):
        parent = left.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("p"))
        jump = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
        parent = saved(parent.join(jump, "p", "left").select(F.col("a").alias("v"), F.coalesce("q", "p").alias("label")))
        if labels is None:
            labels = parent
        else:
            step = parent.select(F.col("v").alias("label"), F.col("label").alias("next"))
            labels = saved(labels.join(step, "label", "left").select("v", F.coalesce("next", "label").alias("label")))
        to_a, to_b = parent.select(F.col("v").alias("a"), F.col("label").alias("la")), parent.select(F.col("v").alias("b"), F.col("label").alias("lb"))
        left = saved(left.join(to_a, "a").join(to_b, "b").filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
    if labels is None:
        return edges.sparkSession.createDataFrame([], "v long, label long")
    return labels
