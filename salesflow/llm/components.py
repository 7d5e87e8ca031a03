"""Connected components of an undirected edge table by contraction.

In a round every node takes the smallest node among itself and its neighbours as its
label, and the edges are drawn between labels; loops and repeated edges fall away. A node
that has an edge shares its label with a neighbour at least, so the number of rounds is logarithmic.
The labels of the rounds, applied one after the other, lead to a component's smallest node.

Edges stay distributed: a round's labels and edges are written to the shared folder
(cutting lineage) and only the number of edges that are left comes back. Minima are aggregated before they are
joined back, so a node with very many neighbours is a row in the aggregate and its
join is one that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import discard, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the smallest node it can reach. Loops are ignored."""
    edges = written(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while edges.head(1):
        ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        labels = written(ends.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("label")), "labels")
        one = edges.join(labels, F.col("u") == F.col("node")).select(F.col("label").alias("a"), "v")
        two = one.join(labels, F.col("v") == F.col("node")).select("a", F.col("label").alias("b"))
        before, edges = edges, written(two.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        discard(before)
        rounds.append(labels)
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = rounds[0].withColumnRenamed("label", "root")
    for labels in rounds[1:]:  # a label without an edge in a later round stays
        out = out.join(labels.withColumnsRenamed({"node": "_node", "label": "_label"}), F.col("root") == F.col("_node"), "left").select(
            "node", F.coalesce("_label", "root").alias("root"))
    return out
