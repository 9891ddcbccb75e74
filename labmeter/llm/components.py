"""Connected components by contraction, kept in tables from step to step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmeter.llm.scratch import keep


def connect(edges: DataFrame) -> DataFrame:
    """(node, root) for the ends of the edges (a, b), one root for each component.

    In every round each node moves to the smallest node next to it and the edges between
    the moved nodes remain. Nodes are numbered by hashes, so that rounds grow with the logarithm
    of a component's length.
    """
    edges = keep(edges.select("a", "b").filter("a <> b"), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = keep(both.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to")), "moved")
        if roots is None:
            roots = moved.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            step = moved.select(F.col("a").alias("root"), "to")
            roots = keep(
                roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
            )
        edges = keep(
            edges.join(moved.select("a", F.col("to").alias("x")), "a")
            .join(moved.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
            .filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")), "edges",
        )
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(ref, label) after links (a, b) between refs have joined their components."""
    a = labels.select(F.col("ref").alias("a"), F.col("label").alias("x"))
    b = labels.select(F.col("ref").alias("b"), F.col("label").alias("y"))
    edges = links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = connect(edges)
    return keep(
        labels.join(roots.withColumnRenamed("node", "label"), "label", "left")
        .select("ref", F.coalesce("root", "label").alias("label")), "labels",
    )
