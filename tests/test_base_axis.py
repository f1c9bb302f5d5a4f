"""Segmentation on single positions against a loop over all bases."""

import random

import numpy as np
import pytest

from basetide import adapters as A
from basetide.catalog import segments
from basetide.operators import segment
from basetide.operators.segment import HmmParams

D = "/root/testdata/sf0.001"


def loop(length, sites, p):
    """State of every base."""
    t0, t1, e0, e1, s0 = p.clamped()
    emit = [(e0, 1 - e1), (1 - e0, e1)]
    a = b = 0.0
    out = np.zeros(length, bool)
    for k in range(length):
        a, b = (s0, 1 - s0) if k == 0 else (t0 * a + (1 - t1) * b, (1 - t0) * a + t1 * b)
        e = emit[k in sites]
        a, b = a * e[0], b * e[1]
        a, b = a / (a + b), b / (a + b)
        out[k] = b - a > 1e-12
    return out


def stretches(states, sites):
    edge = np.flatnonzero(np.diff(np.r_[0, states.astype(int), 0]))
    return [(int(s), int(e), sum(x in sites for x in range(s, e))) for s, e in zip(edge[::2], edge[1::2])]


def report(found, length, min_len, max_len):
    """total, short, long, length, gap, sites, density of the kept elements."""
    total = [x for x in found if x[0] > 0]
    closed = [x for x in total if x[1] < length]
    short, long = [x for x in closed if x[1] - x[0] <= min_len], [x for x in closed if x[1] - x[0] > min_len and x[1] - x[0] >= max_len]
    kept = [x for x in closed if x not in short and x not in long]
    gaps = sum(b[0] - a[1] for a, b in zip(kept, kept[1:]))
    final = len(total) - len(short) - len(long)
    mean = lambda x: x / final if final > 0 else 0.0
    return (len(total), len(short), len(long), final, mean(sum(e - s for s, e, _ in kept)), mean(gaps), sum(n for *_, n in kept),
            mean(sum(n / (e - s) for s, e, n in kept)))


def test_two_chromosomes_equal_the_loop(spark):
    """The first 300,000 bases of two chromosomes of the given sites, in order of their names."""
    cons, lengths = segments._bases(spark, D)
    names = sorted(r.chrom for r in lengths.collect())[:2]
    cut_at = 300_000
    short = lengths.where(lengths.chrom.isin(names)).selectExpr("chrom", f"least(length, {cut_at}) AS length")
    near = cons.where(cons.chrom.isin(names) & (cons.start < cut_at))
    sites = {c: {r.start for r in near.collect() if r.chrom == c} for c in names}
    want = sorted((p.param_id, c, *x) for p in segments.PARAMS for c in names for x in stretches(loop(cut_at, sites[c], p), sites[c]))
    out = segment.hmm_segment(near, short, segments.PARAMS)
    got = sorted((r.param_id, r.chrom, r.start, r.end, r.num_conserved) for r in out.collect())
    assert got == want and len(got) > 5
    assert any(e - s < 3600 for _, _, s, e, _ in got)


def grid_sample():
    """Every 83rd set of the full grid, and the given ones."""
    return segments.FULL_GRID[::83] + [HmmParams(7000 + p.param_id, *p.clamped()) for p in segments.PARAMS]


@pytest.fixture(scope="module")
def small(spark):
    rng = random.Random(8)
    lengths = {"a": 900, "b": 257, "c": 1}
    sites = {"a": set(), "b": set(), "c": {0}}
    for c in "ab":
        at = 0
        while at < lengths[c]:
            run = rng.choice([1, 1, 1, 2, 6])
            if rng.random() < 0.5:
                sites[c].update(range(at, min(at + run, lengths[c])))
            at += run + rng.choice([1, 3, 10, 60])
    rows = [(c, s, s + 1) for c, x in sites.items() for s in x]
    return (spark.createDataFrame(rows, "chrom string, start long, end long"),
            spark.createDataFrame(list(lengths.items()), "chrom string, length long"), lengths, sites)


@pytest.mark.parametrize("tile, block", [(64, 16), (1, 7), (100_000, 256)])
def test_grid_fold_equals_the_loop(spark, small, tile, block):
    frame, index, lengths, sites = small
    sets = grid_sample()
    got = {(r.param_id, r.chrom): tuple(r)[4:12] for r in segment.hmm_grid_summary(frame, index, sets, 3, 20, tile, block).collect()}
    assert len(got) == len(sets) * len(lengths)
    for p in sets:
        for c, n in lengths.items():
            want = report(stretches(loop(n, sites[c], p), sites[c]), n, 3, 20)
            assert got[p.param_id, c] == pytest.approx(want, rel=1e-12), (p, c)


def test_fold_and_summary_of_stretches_agree(spark, small):
    frame, index, *_ = small
    sets = grid_sample()[::6]
    key = lambda r: (r[0], r[1])
    one = sorted(map(tuple, segment.hmm_grid_summary(frame, index, sets, 2, 30, 50).collect()), key=key)
    two = sorted(map(tuple, segment.hmm_summary(segment.hmm_segment(frame, index, sets, tile_width=50), frame, index, sets, 2, 30).collect()), key=key)
    assert len(one) == len(two)
    for a, b in zip(one, two):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9)


def test_states_equal_the_loop(spark, small):
    frame, index, lengths, sites = small
    found = segment.hmm_segment(frame, index, segments.PARAMS, tile_width=64)
    got = segment.state_sequence(found, frame, index, [p.param_id for p in segments.PARAMS], 3, 20, tile_width=50).collect()
    rows = {(r.param_id, r.chrom, r.pos): r for r in got}
    assert len(rows) == len(got) == 3 * sum(lengths.values())
    for p in segments.PARAMS:
        for c, n in lengths.items():
            states = loop(n, sites[c], p)
            ended = {e: (s, k) for s, e, k in stretches(states, sites[c]) if s > 0}
            for pos in range(n):
                r = rows[p.param_id, c, pos]
                assert (r.symbol, r.state, r.place) == (int(pos in sites[c]), int(states[pos]), "IN" if states[pos] else "OUT")
                if pos and states[pos] and not states[pos - 1]:
                    assert r.change == "START"
                elif pos in ended:
                    s, k = ended[pos]
                    assert (r.change, r.elem_start, r.elem_end, r.elem_length) == ("END", s, pos, pos - s)
                    assert r.elem_density == (pytest.approx(k / (pos - s)) if 3 < pos - s < 20 else None)
                else:
                    assert r.change == "" and r.elem_start is None


def test_states_move_no_row_of_a_base(spark, small):
    """Sites, stretches and elements are exchanged; above the rows of bases there is no exchange."""
    frame, index, *_ = small
    found = segment.hmm_segment(frame, index, segments.PARAMS)
    plan = segment.state_sequence(found, frame, index, [0, 1, 2])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("MapInArrow")


def test_stretches_of_the_given_sites(spark):
    lengths = {r.chrom: r.length for r in A.chromes(spark, D).collect()}
    got = segments.hmm_stretches(spark, D).collect()
    assert any(r.end - r.start < 3600 and r.opened and r.closed for r in got)
    assert max(r.end for r in got) > max(lengths.values()) // 3600 + 1
    assert all(r.closed == (r.end < lengths[r.chrom]) for r in got)


def test_the_grid_is_the_full_grid():
    assert len({(p.t0_0, p.t1_1, p.e0_0, p.e1_1) for p in segments.FULL_GRID}) == 9 ** 4
