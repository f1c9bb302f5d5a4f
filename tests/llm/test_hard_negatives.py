"""Hard negatives against brute force; coordinate ranges and buckets lose nothing."""

import numpy as np
import pytest

from basetide.llm import hard_negatives as hn

RNG = np.random.default_rng(4)


def plain(rows, anchors, n_pos, n_neg, band):
    own = {}
    for i, label, v in anchors:
        if None not in (i, label, v):
            own[i] = min(own.get(i, (label, v)), (label, v))
    fine = [(i, label, v) for i, label, v in rows if None not in (i, label, v)]
    out = []
    for a, (label, v) in own.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in fine if i != a and len(w) == len(v)]
        scored.sort()
        for r, (ps, p, _) in enumerate([s for s in scored if s[2] == label][:n_pos], 1):
            hits = [s for s in scored if s[2] != label and band.low * -ps <= band.scale * -s[0] <= band.high * -ps][:n_neg]
            out += [(a, p, r, k, i, -ps, -s) for k, (s, i, _) in enumerate(hits, 1)]
    return sorted(out)


def some_rows(n, dim=6, labels=3):
    base = RNG.normal(size=(5, dim))
    x = np.floor(40 * (base[RNG.integers(0, 5, n)] + 0.4 * RNG.normal(size=(n, dim))) * RNG.choice([0.2, 1, 3], (n, 1)))
    return [(int(k), int(RNG.integers(0, labels)), [int(c) for c in r]) for k, r in enumerate(x)]


def test_candidates_never_miss_a_row_that_reaches_the_score():
    rows = RNG.integers(-50, 50, (300, 8))
    rows[7] = 0
    for part in (rows, rows[rows.any(axis=1)]):
        bucket = hn.Bucket(np.arange(len(part)), part)
        for anchor in [*RNG.integers(-50, 50, (20, 8)), np.zeros(8, int), part[3]]:
            scores = hn.exact(part, anchor)
            length = float(np.sqrt((anchor.astype(float) ** 2).sum()))
            for t in (-np.inf, -5000, -1, 0, 1, 2000, int(scores.max()), int(scores.max()) + 1):
                found = set(bucket.candidates(anchor.astype(float), length, t).tolist())
                assert set(np.flatnonzero(scores >= t).tolist()) <= found
    tight = bucket.candidates(part[3].astype(float), float(np.sqrt((part[3] ** 2).sum())), int((part[3] ** 2).sum()))
    assert len(tight) < len(part) // 4  # the ranges do cut


@pytest.mark.parametrize("tile, bytes_", [(8192, 64 << 20), (7, 64 << 20), (16, 0)])
def test_against_brute_force(spark, monkeypatch, tile, bytes_):
    monkeypatch.setattr(hn, "BROADCAST_BYTES", bytes_)
    rows = some_rows(260)
    rows += [(300, 0, [0] * 6), (301, 1, [0] * 6), (302, 1, None), (303, None, [1] * 6), (None, 1, [1] * 6), (304, 0, [1, 2]),
             (305, 1, [2, 2]), (306, 0, [3, 1]), (5, *rows[5][1:]), (5, *rows[6][1:]), (310, 2, []), (311, 2, []), (312, 1, [])]
    rows += [(400 + k, *rows[9][1:]) for k in range(30)]  # ties
    anchors = [r for r in rows if r[0] is not None and r[0] % 5 == 0]
    schema = "id long, label int, v array<long>, rank int, score double"
    frame = lambda x: spark.createDataFrame([(*r, 1, 1.0) for r in x], schema).repartition(3)
    got = hn.hard_negatives(frame(rows), frame(anchors), 5, 10, tile=tile)
    assert sorted(map(tuple, got.collect())) == plain(rows, anchors, 5, 10, hn.Band())


def test_empty_sides(spark):
    rows = spark.createDataFrame(some_rows(20), "id long, label int, v array<long>")
    assert hn.hard_negatives(rows, rows.limit(0)).collect() == []
    assert hn.hard_negatives(rows.limit(0), rows).collect() == []
