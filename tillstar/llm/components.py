"""Connected components of links between 64-bit keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.tables import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): every linked node with the smallest node it can reach.

    In a round every node points to its smallest neighbour, or to itself if it is
    smaller; pointers are followed to their ends by doubling, and the links are
    replaced by those between the ends. A dense group falls into one node at once
    and its links with it, so that later rounds work on few rows; at least half of
    the linked nodes go in each. Tables are written between steps, so joins read
    written tables on both sides and adaptive execution can split a hot node.
    """
    edges = stored(links.select(F.col(a).alias("a"), F.col(b).alias("b")), "edges")
    labels = None
    while not edges.isEmpty():
        ends = _followed(_smallest_neighbours(edges))
        if labels is None:
            labels = ends.select("node", F.col("end").alias("label"))
        else:
            labels = stored(
                labels.join(ends.withColumnRenamed("node", "label"), "label", "left").select(
                    "node", F.coalesce("end", "label").alias("label")), "labels")
        of_a = ends.select(F.col("node").alias("a"), F.col("end").alias("x"))
        of_b = ends.select(F.col("node").alias("b"), F.col("end").alias("y"))
        edges = stored(
            edges.join(of_a, "a").join(of_b, "b").filter("x <> y").select(
                F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def _smallest_neighbours(edges: DataFrame) -> DataFrame:
    """(node, end): the smallest of a node and its neighbours."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    return stored(
        both.groupBy("node").agg(F.min("other").alias("other"))
        .select("node", F.least("node", "other").alias("end")), "pointers")


def _followed(pointers: DataFrame) -> DataFrame:
    """``pointers`` with ``end`` followed until it points to itself."""
    while True:
        onward = pointers.select(F.col("node").alias("end"), F.col("end").alias("next"))
        longer = stored(pointers.join(onward, "end").select(
            "node", F.col("next").alias("end"), (F.col("next") != F.col("end")).alias("moved")),
            "pointers")
        pointers = longer.select("node", "end")
        if longer.filter("moved").isEmpty():
            return pointers
