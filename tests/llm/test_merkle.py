"""Merkle manifest against a plain tree: postorder places, proofs, tampering, nulls, repeated rows."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basetide.llm import merkle

RNG = random.Random(11)
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x):
    return hashlib.sha256(x).hexdigest()


def leaf(row):
    parts = [None if v is None else str(v).encode() for v in row]
    return sha(b"".join(b"-" if v is None else str(len(v)).encode() + b":" + v for v in parts))


def plain_tree(nodes, arity):
    """(root, path of every leaf) by levels."""
    paths, own = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_own = [], []
        for lo in range(0, len(nodes), arity):
            run = nodes[lo:lo + arity]
            for k in range(len(run)):
                for i in own[lo + k]:
                    paths[i].append((k, run[:k] + run[k + 1:]))
            up.append(sha("".join(run).encode()))
            up_own.append([i for g in own[lo:lo + arity] for i in g])
        nodes, own = up, up_own
    return nodes[0], paths


def plain_proofs(rows, arity=8):
    """rows: (doc_id, source, lang, n_chars, text)"""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [plain_tree([leaf(r) for r in groups[x]], arity) for x in langs]
    root, tops = plain_tree([t[0] for t in trees], arity)
    out = []
    for lang, (sub, paths), top in zip(langs, trees, tops):
        for r, path in zip(groups[lang], paths):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            folded = leaf((*r[:4], r[4].translate(LOW))) if bad else leaf(r)
            for k, others in path + top:
                folded = sha("".join([*others[:k], folded, *others[k:]]).encode())
            proof = sha("".join(s for _, others in path + top for s in others).encode())
            out.append((r[0], r[2], leaf(r), sub, root, proof, folded, folded == root))
    return out


@pytest.mark.parametrize("n, arity", [(1, 8), (2, 8), (8, 8), (9, 8), (64, 8), (65, 8), (73, 8), (512, 8), (700, 8), (5, 2), (31, 3)])
def test_closed_form_places_equal_the_order_of_completion(n, arity):
    for height in (merkle.tree_height(n, arity), merkle.tree_height(n, arity) + 2):
        leaves = [sha(str(k).encode()).encode() for k in range(n)]
        log = merkle.postorder(leaves, height, arity)
        level, nodes = leaves, [leaves]
        for _ in range(height):
            level = [sha(b"".join(level[k:k + arity])).encode() for k in range(0, len(level), arity)]
            nodes.append(level)
        assert sorted(p for h in merkle.places(n, height, arity) for p in h) == list(range(len(log)))
        for h, where in enumerate(merkle.places(n, height, arity)):
            assert [log[p] for p in where] == nodes[h]
        assert merkle.position(height, 0, n, height, arity) == len(log) - 1


def rows_of(n):
    langs = ["en"] * 6 + ["de", None, "", "éa", "z"]
    out = [(k, RNG.choice(["s", None]), RNG.choice(langs), RNG.choice([None, k]), "Ab Cé " * RNG.randrange(4)) for k in range(n)]
    return out + [(None, "s", "en", 1, "No ID"), (3, None, "en", None, None), (3, None, "en", None, None), (-6, "s", "one", 2, "X"),
                  (2, "s", "en", 1, "A" * 300_000)]


def proofs(spark, rows, levels):
    data = [(*r, "g", 1, "d", 2.0) for r in rows]
    docs = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string, `group` string, id int, "
                                       "digest string, changed double").repartition(3)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    manifest = merkle.build(merkle.document_leaves(docs, crc % 3 == 0), "group", "id", ["changed"], levels=levels)
    return [tuple(r) for r in merkle.prove(manifest, "changed").collect()], manifest


@pytest.mark.parametrize("n, levels", [(300, 4), (300, 1), (100, 2)])
def test_proofs_equal_those_of_a_plain_tree(spark, n, levels):
    rows = rows_of(n)
    got, manifest = proofs(spark, rows, levels)
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(plain_proofs(rows), key=key)
    assert 0 < sum(not r[-1] for r in got) < len(got)
    size = 8 ** levels
    assert all(len(r.nodes) // 32 == sum(merkle.sizes(r.m, r.height)) and r.m <= size for t in manifest.within for r in t.collect())


def test_one_row_and_none(spark):
    row = (7, "s", "en", 1, "x")
    got, _ = proofs(spark, [row], 4)
    assert got == plain_proofs([row]) and got[0][2] == got[0][3] == got[0][4]
    assert proofs(spark, [], 4)[0] == []


def test_position_takes_arrays():
    assert merkle.position([0, 0, 1], [0, 1, 0], 2, 1, 8).tolist() == [0, 1, 2] and isinstance(np.int64(0), np.integer)
