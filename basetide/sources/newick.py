"""Newick text to an edge table, for tables of many trees."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "tree_id string, node int, parent int, label string, branch_length double"
_NAMES = ["tree_id", "node", "parent", "label", "branch_length"]
_TYPES = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64())
#: Rows of a batch that is sent on.
BATCH_ROWS = 50_000
_TOKEN = re.compile(r"\(|\)|,|;|:[^,();]*|[^,():;]+")


def _edges(text: str) -> list[list]:
    """Rows [is_tip, parent row, label, length] in order of opening."""
    rows: list[list] = [[True, None, None, None]]
    here = 0
    for token in _TOKEN.findall(text):
        if token == "(":
            rows[here][0] = False
            rows.append([True, here, None, None])
            here = len(rows) - 1
        elif token == ",":
            rows.append([True, rows[here][1], None, None])
            here = len(rows) - 1
        elif token == ")":
            here = rows[here][1]
        elif token.startswith(":"):
            rows[here][3] = float(token[1:])
        elif token != ";" and token.strip():
            rows[here][2] = token.strip()
    return rows


def _numbered(text: str) -> list[tuple]:
    """Tips get 1..n in text order, then inner nodes n+1.. with the root first."""
    rows = _edges(text)
    tips = sum(r[0] for r in rows)
    ids, next_tip, next_inner = [], 1, tips + 1
    for is_tip, *_ in rows:
        ids.append(next_tip if is_tip else next_inner)
        next_tip, next_inner = (next_tip + 1, next_inner) if is_tip else (next_tip, next_inner + 1)
    return [(ids[i], None if parent is None else ids[parent], label, length)
            for i, (_, parent, label, length) in enumerate(rows)]


def newick_to_nodes(trees: DataFrame) -> DataFrame:
    """(tree_id, newick) -> (tree_id, node, parent, label, branch_length), one tree at a time; the rows of many trees leave
    a task as one batch of some ``BATCH_ROWS``."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:
            for tree_id, text in zip(b.column("tree_id").to_pylist(), b.column("newick").to_pylist()):
                rows += [(tree_id, *r) for r in _numbered(text)]
                if len(rows) >= BATCH_ROWS:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    return trees.select(F.coalesce(F.col("tree_id").cast("string"), F.lit("None")).alias("tree_id"), "newick").mapInArrow(parse, SCHEMA)
