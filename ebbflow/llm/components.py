"""Connected components of an edge table by alternating large-star and small-star steps.

First every node is replaced by its smallest neighbour (or itself, if smaller): a group of many nodes around few small ones, the usual shape of a
group of copies, then is an edge or two, and only these go through the steps. The labels found are handed back to the nodes by one join.
Each step rewires every edge towards the smallest neighbour; no step holds a component in one task. The edges of a hub meet
in a join that Spark may split; the minimum per node is combined before the shuffle. Steps end when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, label) of every node of ``edges`` (columns a, b); the label is the smallest id of the component."""
    edges = edges.filter("a <> b").select("a", "b")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    parents = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("parent")), name)
    held = edges.join(parents.toDF("a", "x"), "a").join(parents.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = _stars(held, name)
    labels = parents.join(found.toDF("parent", "label"), "parent", "left")
    return labels.select("id", F.coalesce("label", "parent").alias("label"))


def _stars(edges: DataFrame, name: str) -> DataFrame:
    """(id, label) of every node of ``edges`` that has an edge to another node."""
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, name)
    state = _state(edges)
    while True:
        # large star: every larger neighbour is tied to the smallest neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = materialize(large, name)
        # small star: every neighbour that is not larger, and the node itself, are tied to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialize(small.select("e.a", "e.b").filter("a <> b").distinct(), name)
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())
