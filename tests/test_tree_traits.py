"""Traits handed up deep trees, without pairs of nodes and ancestors."""

import random

import pytest
from pyspark.sql import functions as F

from basetide.operators import tree

NODES = "tree_id int, node int, parent int, label string, trait string"


def brute(rows):
    """Trait of every node by recursion over children."""
    below = {}
    for t, n, p, _, _ in rows:
        below.setdefault((t, p), []).append(n)
    value = {(t, n): v for t, n, _, _, v in rows}

    def tips(t, root):
        out, todo = [], [root]
        while todo:
            n = todo.pop()
            kids = below.get((t, n), [])
            todo += kids
            if not kids:
                out.append(value[t, n])
        return [v for v in out if v is not None]

    return sorted((t, n, "Y" if (t, n) in below and tips(t, n) and set(tips(t, n)) == {"Y"} else value[t, n]) for t, n, *_ in rows)


def got(spark, rows):
    out = tree.propagate_trait(spark.createDataFrame(rows, NODES).repartition(3), "trait")
    return sorted((r.tree_id, r.node, r.trait) for r in out.collect())


def test_random_trees(spark):
    rng, rows = random.Random(4), []
    for t in range(6):
        for n in range(rng.randrange(1, 60)):
            rows.append((t, n, rng.randrange(max(0, n - 4), n) if n else None, f"l{n}", rng.choice(["Y", "Y", "Y", "N", None])))
    assert sorted(map(str, got(spark, rows))) == sorted(map(str, brute(rows)))


def test_a_chain_of_three_thousand_nodes(spark):
    rows = [(0, n, n - 1 if n else None, str(n), "N") for n in range(3000)] + [(0, 5000, 2999, "tip", "Y"), (0, 5001, 1500, "tip", "N")]
    out = dict(((n, v) for _, n, v in got(spark, rows)))
    assert {out[n] for n in range(1501, 3000)} == {"Y"} and {out[n] for n in range(1501)} == {"N"}


def test_cycles_are_errors(spark):
    for loop in ([(0, 1, 1)], [(0, 1, 2), (0, 2, 1)], [(0, 1, 2), (0, 2, 3), (0, 3, 1), (0, 4, 1)]):
        df = spark.createDataFrame([(*x, "a", "Y") for x in loop], NODES)
        with pytest.raises(ValueError, match="own ancestor"):
            tree.propagate_trait(df.withColumn("trait", F.lit("Y")), "trait")
