"""Connected components of a link table, by repeated hooking and contraction.

Every round each node points to the smallest node it is linked with, the pointers are followed twice, and
the links are rewritten between the nodes pointed to. Links shrink from round to round; a long chain takes
a logarithmic number of rounds in practice. Rounds end with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basetide.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable. Equal, reversed and
    self links are allowed; self links alone give a node its own root. A hot node is a group of an
    aggregate with partial sums, never a collected list."""
    edges = links.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"))
    labels, pointers = nodes, nodes
    edges = edges.where("a <> b")
    while True:
        hop = pointers.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        # follow each pointer once more
        pointers = pointers.join(hop, F.col("root") == F.col("_n"), "left").select(
            "node", F.coalesce("_r", "root").alias("root"))
        a = pointers.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
        b = pointers.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
        edges = cut(edges.join(a, "a").join(b, "b").where("_ra <> _rb")
                    .select(F.least("_ra", "_rb").alias("a"), F.greatest("_ra", "_rb").alias("b")).distinct())
        step = pointers.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        labels = labels.join(step, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root"))
        if edges.isEmpty():
            return _settled(cut(labels))
        labels = cut(labels)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"))


def _settled(labels: DataFrame) -> DataFrame:
    """Follow roots until they point to themselves."""
    while True:
        up = labels.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        nxt = cut(labels.join(up, F.col("root") == F.col("_n"), "left").select(
            "node", "root", F.coalesce("_r", "root").alias("_next")))
        moved = nxt.where("root <> _next")
        labels = nxt.select("node", F.col("_next").alias("root"))
        if moved.isEmpty():
            return labels
