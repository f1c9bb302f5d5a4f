"""Clades and traits on tables of trees (edge tables: tree_id, node, parent, label, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basetide.plans.lineage import written


def ancestor_pairs(nodes: DataFrame) -> DataFrame:
    """Every (tree_id, node, ancestor, steps), steps >= 1, by path doubling.

    Round k extends the pairs exactly 2^k steps apart by all pairs known so far, so a tree of depth
    d takes about log2(d) rounds and no pair is ever made twice. Each round is written once, as
    compressed columns.
    """
    pairs = written(nodes.where(F.col("parent").isNotNull())
                    .select("tree_id", "node", F.col("parent").alias("ancestor"), F.lit(1).alias("steps")), "pairs")
    reach = 1
    while True:
        far = pairs.where(F.col("steps") == reach)
        onward = pairs.select("tree_id", F.col("node").alias("ancestor"), F.col("ancestor").alias("_next"),
                              F.col("steps").alias("_more"))
        longer = far.join(onward, ["tree_id", "ancestor"]).select(
            "tree_id", "node", F.col("_next").alias("ancestor"), (F.col("steps") + F.col("_more")).alias("steps"))
        longer = written(longer, "pairs")
        if not longer.where("node = ancestor").isEmpty():
            raise ValueError("a node is its own ancestor")
        if longer.isEmpty():
            return pairs
        pairs, reach = pairs.unionByName(longer), reach * 2


def node_types(nodes: DataFrame) -> DataFrame:
    """Add ``node_type``: ROOT (no parent), tip (no child) or internal."""
    parents = nodes.where(F.col("parent").isNotNull()).select("tree_id", F.col("parent").alias("node")).distinct()
    marked = nodes.join(parents.withColumn("_inner", F.lit(True)), ["tree_id", "node"], "left")
    kind = F.when(F.col("_inner").isNull(), "tip").when(F.col("parent").isNull(), "ROOT").otherwise("internal")
    return marked.withColumn("node_type", kind).drop("_inner")


def tree_info(nodes: DataFrame) -> DataFrame:
    """Per node: the sorted tip labels below it joined by ";", node type, branch length, label.
    A clade text is as long as its tree is wide, which is the size of the asked-for result."""
    typed = written(node_types(written(nodes, "nodes")), "typed")
    tip = F.col("node_type") == "tip"
    # tips are gathered at their parents first, so that pairs are made of inner nodes only
    lists = written(typed.where(tip & F.col("parent").isNotNull()).groupBy("tree_id", F.col("parent").alias("node"))
                    .agg(F.collect_list("label").alias("tips")), "tips")
    below = ancestor_pairs(typed.where(~tip)).join(lists, ["tree_id", "node"]).select("tree_id", F.col("ancestor").alias("node"), "tips")
    clades = (below.unionByName(lists).groupBy("tree_id", "node")
              .agg(F.array_join(F.sort_array(F.flatten(F.collect_list("tips"))), ";").alias("clade")))
    rows = typed.select("tree_id", "node", "node_type", "branch_length", "label")
    inner = rows.where(~tip).join(clades, ["tree_id", "node"], "full")
    return inner.unionByName(rows.where(tip).withColumn("clade", F.coalesce("label", F.lit("")))).select(
        "tree_id", "node", "clade", "node_type", "branch_length", "label")


def annotate_tree(nodes: DataFrame, info: DataFrame, trait: str, name_col: str = "species") -> DataFrame:
    """Left join of nodes with metadata on label (blanks in names become "_"); the trait column
    becomes "Y" when it has text and "N" otherwise."""
    named = info.select(F.replace(F.col(name_col), F.lit(" "), F.lit("_")).alias("label"), F.col(trait).alias("_t"))
    joined = nodes.join(named, "label", "left")
    flag = F.when(F.col("_t").isNull() | (F.col("_t") == ""), "N").otherwise("Y")
    return joined.withColumn(trait, flag).drop("_t")


def spread_to_ancestors(nodes: DataFrame, marks: DataFrame, flags: list[str]) -> DataFrame:
    """(tree_id, node, *flags): every node with the flags of ``marks`` (tree_id, node, *flags) that it or a node below it has.

    After round k a node knows of marks less than 2^k steps below it and points 2^k steps up; handing its flags to where it
    points doubles both. Tables stay as long as the tree, no pair of a node and an ancestor is made, and a tree of depth d takes
    about log2(d) rounds.
    """
    keys = ["tree_id", "node"]
    jump = written(nodes.where(F.col("parent").isNotNull()).select(*keys, F.col("parent").alias("up")), "jump")
    state = written(marks.select(*keys, *flags), "state")
    reach, longest = 1, None
    while True:
        left = jump.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.col("up") == F.col("node")), F.lit(False)).alias("own")).first()
        longest = left["n"] if longest is None else longest
        if left["own"] or (left["n"] and reach > longest):
            raise ValueError("a node is its own ancestor")
        if not left["n"]:
            return state
        handed = state.join(jump, keys).select("tree_id", F.col("up").alias("node"), *flags)
        state = written(state.unionByName(handed).groupBy(*keys).agg(*(F.max(f).alias(f) for f in flags)), "state")
        onward = jump.select("tree_id", F.col("node").alias("up"), F.col("up").alias("_next"))
        jump = written(jump.join(onward, ["tree_id", "up"]).select(*keys, F.col("_next").alias("up")), "jump")
        reach *= 2


def propagate_trait(nodes: DataFrame, trait: str) -> DataFrame:
    """An internal node becomes "Y" when all tips below it are "Y"; otherwise it keeps its value. Tips without a value count
    neither way."""
    typed = written(node_types(written(nodes, "nodes")), "typed")
    yes = F.col(trait) == "Y"
    tip = F.col("node_type") == "tip"
    # tips hand their value to their parents first, so that marks go up inner nodes only
    marks = (typed.where(tip & yes.isNotNull() & F.col("parent").isNotNull()).groupBy("tree_id", F.col("parent").alias("node"))
             .agg(F.max(yes).alias("_y"), F.max(~yes).alias("_n")))
    inner = typed.where(~tip)
    below = spread_to_ancestors(inner, marks, ["_y", "_n"])
    changed = (inner.join(below, ["tree_id", "node"], "left")
               .withColumn(trait, F.when(F.col("_y") & ~F.col("_n"), "Y").otherwise(F.col(trait))).drop("_y", "_n"))
    return changed.unionByName(typed.where(tip))
