"""Connected components of an edge table, by contraction, with every step in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Staged


def components(edges: DataFrame, st: Staged) -> DataFrame:
    """``node, label`` for each node of ``edges`` (``a, b`` long): the label is the smallest node of its component.

    Each round gives every node the smallest of its neighbours and itself, shortens the chains this makes until they are
    flat, and replaces nodes by these labels; edges within a label vanish. The labels of all rounds are then composed.
    Minima are combined before they are shuffled, so a node with any number of edges costs one row per task.
    """
    nodes = None
    edges = st.write(edges.where("a <> b").distinct(), "cc-edges")
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = st.write(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-parents")
        while True:
            up = parent.select(F.col("node").alias("label"), F.col("label").alias("above"))
            higher = st.write(parent.join(up, "label").select("node", F.col("above").alias("label"), (F.col("above") != F.col("label")).alias("moved")), "cc-parents")
            st.drop(parent)
            parent = higher.select("node", "label")
            parent._staged_path = higher._staged_path
            if higher.where("moved").isEmpty():
                break
        a, b = (parent.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
        fewer = edges.join(a, "a").join(b, "b").where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
        fewer = st.write(fewer, "cc-edges")
        st.drop(edges)
        edges = fewer
        if nodes is None:
            nodes = parent
        else:
            after = parent.select(F.col("node").alias("label"), F.col("label").alias("root"))
            new = st.write(nodes.join(after, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "cc-nodes")
            st.drop(nodes, parent)
            nodes = new
    if nodes is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes
