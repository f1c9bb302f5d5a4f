"""Operators against small brute-force versions, with tiles and hot-key limits set far below the
data size so that every seam and every salt is crossed."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basetide.operators import alignment, cluster, grid, intervals, patterns, segment, sites, stats
from basetide.plans.ordered import Scan, exact_quantiles, ordered_scan, position_tile, value_histogram
from basetide.plans.skew import lookup_join

IV = "chrom string, start long, end long"
RARE = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def random_intervals(seed, n=300, span=2000, longest=60):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        s = r.randrange(span) if r.random() < 0.7 else 500
        out.append((r.choice(["c1", "c1", "c1", "c2"]), s, s + r.randint(1, longest if r.random() < 0.95 else 900)))
    return out


def got(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


@pytest.mark.parametrize("fn,reverse,inclusive", [
    ("sum", False, True), ("sum", True, False), ("max", False, False), ("min", True, True), ("last", False, False),
    ("last", True, False), ("total", False, True)])
def test_ordered_scan_matches_a_loop(spark, fn, reverse, inclusive):
    r = random.Random(3)
    data = [(k, x, r.choice([None, r.randint(-5, 5)])) for k in "ab" for x in sorted(r.sample(range(400), 60))]
    df = spark.createDataFrame(data, "k string, x long, v long").withColumn("_t", position_tile("x", 16))
    out = ordered_scan(df, ["k"], "x", "_t", [Scan("o", fn, "v", reverse, inclusive)])
    want = []
    for k in "ab":
        rows = [d for d in data if d[0] == k]
        rows = rows[::-1] if reverse else rows
        for i, (_, x, v) in enumerate(rows):
            seen = [w for _, _, w in (rows[: i + inclusive] if fn != "total" else rows) if w is not None]
            o = {"sum": lambda s: sum(s), "total": lambda s: sum(s), "max": lambda s: max(s, default=None),
                 "min": lambda s: min(s, default=None), "last": lambda s: s[-1] if s else None}[fn](seen)
            want.append((k, x, o))
    assert got(out, "k", "x", "o") == sorted(want)


def bh_loop(ps):
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    out, low = [0.0] * len(ps), 1.0
    for rank in range(len(ps), 0, -1):
        i = order[rank - 1]
        low = min(low, len(ps) / rank * ps[i])
        out[i] = low
    return out


@RARE
@given(st.lists(st.sampled_from([1.0, 0.5, 0.04, 0.01, 0.001]) | st.floats(1e-9, 1), min_size=1, max_size=80))
def test_bh_matches_a_loop(spark, ps):
    df = spark.createDataFrame([(i, "ab"[i % 2], p) for i, p in enumerate(ps)], "i int, chrom string, p_value double")
    whole = {r["i"]: r["p_adj"] for r in sites.bh_adjust(df, tiles=5).collect()}
    assert np.allclose([whole[i] for i in range(len(ps))], bh_loop(ps))
    split = {r["i"]: r["p_adj"] for r in sites.bh_adjust(df, scope="chrom", tiles=5).collect()}
    for half in (0, 1):
        if ps[half::2]:
            assert np.allclose([split[i] for i in range(half, len(ps), 2)], bh_loop(ps[half::2]))


def test_bh_keeps_missing_p(spark):
    df = spark.createDataFrame([("a", None), ("a", 0.01)], "chrom string, p_value double")
    rows = {r["p_value"]: (r["p_adj"], r["sig"]) for r in sites.bh_adjust(df).collect()}
    assert rows == {0.01: (0.01, 1), None: (None, None)}


def test_lookup_join_spreads_hot_keys_without_loss(spark):
    big = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 7), (3, 8)], "k int, v int")
    counts = spark.createDataFrame([(1, 500, "x"), (2, 1, "y")], "k int, n long, t string")
    out = lookup_join(big, counts, counts, ["k"], "n", hot_rows=50)
    assert got(out.groupBy("k", "t").count()) == sorted([(1, "x", 500), (2, "y", 1), (3, None, 1)], key=str)


def merge_loop(rows, gap):
    out = []
    for c, s, e in sorted(rows):
        if out and out[-1][0] == c and s - out[-1][2] <= gap:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([c, s, e])
    return sorted(tuple(o) for o in out)


@pytest.mark.parametrize("seed,gap", [(1, 0), (2, 5), (3, 40)])
def test_merge_matches_a_loop_and_is_idempotent(spark, seed, gap):
    rows = random_intervals(seed, n=120, span=6000)
    df = spark.createDataFrame(rows, IV)
    merged = intervals.merge_intervals(df, gap, count=True, tile_width=64)
    assert got(merged, "chrom", "start", "end") == merge_loop(rows, gap)
    again = intervals.merge_intervals(merged.select("chrom", "start", "end"), gap, tile_width=64)
    assert got(again, "chrom", "start", "end") == merge_loop(rows, gap)
    assert sum(r[0] for r in got(merged, "n_merged")) == len(rows)


@pytest.mark.parametrize("width,hot", [(None, 10), (7, 10**6), (1000, 5)])
def test_overlap_join_matches_nested_loop(spark, width, hot):
    a, b = random_intervals(4, 150), random_intervals(5, 120)
    out = intervals.overlap_join(spark.createDataFrame(a, IV), spark.createDataFrame(b, IV), width, hot)
    want = sorted((*x, *y, min(x[2], y[2]) - max(x[1], y[1])) for x in a for y in b
                  if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert got(out) == want


def test_overlap_count_matches_nested_loop(spark):
    a, b = random_intervals(6, 150), random_intervals(7, 120)
    out = intervals.overlap_count(spark.createDataFrame(a, IV), spark.createDataFrame(b, IV), tile_width=32)
    want = sorted((*x, sum(x[0] == y[0] and x[1] < y[2] and y[1] < x[2] for y in b)) for x in a)
    assert got(out) == want


def test_wide_range_explodes_in_steps(spark):
    c = spark.createDataFrame([("c", 20001)], "chrom string, length long")
    w = intervals.make_windows(c, 2)
    assert w.count() == 10001 and got(w.orderBy("start").limit(1), "start", "end") == [(0, 2)]
    assert w.agg({"end": "max"}).first()[0] == 20001


def test_pack_runs(spark):
    rows = [("c", 0, 2, 1), ("c", 2, 5, 1), ("c", 5, 6, 2), ("c", 8, 9, 2), ("c", 9, 12, 2), ("d", 12, 13, 2)]
    df = spark.createDataFrame(rows, "chrom string, start long, end long, depth int")
    assert got(intervals.pack_runs(df, "depth", tile_width=3)) == [
        ("c", 0, 5, 1), ("c", 5, 6, 2), ("c", 8, 12, 2), ("d", 12, 13, 2)]


def test_ntile_splits_copies_of_one_position(spark):
    starts = [5] * 37 + [1, 2, 9, 11]
    df = spark.createDataFrame([("c", s) for s in starts], "chrom string, start long")
    sizes = [r[1] for r in got(stats.ntile_bins(df, 4, tile_width=2), "bin", "n")]
    assert sizes == [11, 10, 10, 10]
    few = stats.ntile_bins(spark.createDataFrame([("c", 1), ("c", 2)], "chrom string, start long"), 5)
    assert got(few, "bin", "n") == [(1, 1), (2, 1)]


def test_exact_quantiles_and_histogram(spark):
    r = random.Random(9)
    data = [("a", float(r.randint(0, 30))) for _ in range(200)] + [("b", r.random()) for _ in range(77)]
    df = spark.createDataFrame(data, "k string, v double")
    q = {x["k"]: x for x in exact_quantiles(df, ["k"], "v", {"lo": 0.1, "mid": 0.5, "hi": 0.99}, tiles=7).collect()}
    for k in "ab":
        vals = [v for g, v in data if g == k]
        assert np.allclose([q[k]["lo"], q[k]["mid"], q[k]["hi"]], np.quantile(vals, [0.1, 0.5, 0.99]))
    assert value_histogram(df, ["k"], "v", 3).where("k = 'a'").agg({"cum": "max"}).first()[0] == 200


def test_chi_square_tail_known_values():
    # standard table values of the chi-square distribution
    for x, df, p in ((3.841459, 1, 0.05), (18.307038, 10, 0.05), (124.342113, 100, 0.05), (0.103, 2, math.exp(-0.0515))):
        assert abs(stats.upper_gamma(df / 2, x / 2) - p) < 1e-5
    assert abs(stats.upper_gamma(12500.0, 12500.0) - 0.4988) < 1e-3 and stats.upper_gamma(2, 0) == 1.0


def clusters_loop(xs, size, m, eps):
    core = [x for x in xs if sum(abs(x - y) <= eps for y in xs) >= m]
    groups = []
    for x in sorted(set(core)):
        if groups and x - groups[-1][-1] <= eps:
            groups[-1].append(x)
        else:
            groups.append([x])
    members = [[] for _ in groups]
    for x in xs:
        best = min(((abs(x - c), c > x, i) for i, g in enumerate(groups) for c in g), default=None)
        if best and best[0] <= eps:
            members[best[2]].append(x)
    return sorted((min(g), max(g), len(g)) for g in members if len(g) >= size)


@pytest.mark.parametrize("seed,size,m,eps", [(1, 3, 3, 4), (2, 5, 4, 10), (3, 2, 2, 1), (4, 4, 6, 25)])
def test_clusters_match_a_loop(spark, seed, size, m, eps):
    r = random.Random(seed)
    xs = [r.randrange(600) for _ in range(90)] + [300] * 8
    df = spark.createDataFrame([("c", x) for x in xs], "chrom string, start long")
    found = cluster.cluster_extents(cluster.cluster_positions(df, size, m, eps, tile_width=16))
    assert got(found, "start", "end", "num_conserved") == clusters_loop(xs, size, m, eps)
    assert sorted(int(r[0].split("_")[1]) for r in got(found, "cluster_id")) == list(range(found.count()))


def test_core_distance_crosses_rank_tiles(spark):
    r = random.Random(8)
    xs = sorted(r.sample(range(5000), 200))
    df = spark.createDataFrame([("c", x) for x in xs], "chrom string, start long")
    out = dict(got(cluster.core_distances(df, 6, rank_tile=8, tile_width=32), "start", "core_dist"))
    assert out == {x: sorted(abs(x - y) for y in xs)[5] for x in xs}


def test_default_eps_is_a_percentile_of_core_distances(spark):
    df = spark.createDataFrame([("c", x) for x in (1, 2, 3, 50, 51, 52, 400)], "chrom string, start long")
    out = cluster.cluster_extents(cluster.cluster_positions(df, 3, 2))
    assert got(out, "start", "end") == [(1, 3), (50, 52)]


def hmm_loop(symbols, p):
    t0, t1, e0, e1, s0 = p.clamped()
    emit = [(e0, 1 - e1), (1 - e0, e1)]
    pi, states = None, []
    for x in symbols:
        a, b = (s0, 1 - s0) if pi is None else (t0 * pi[0] + (1 - t1) * pi[1], (1 - t0) * pi[0] + t1 * pi[1])
        a, b = a * emit[x][0], b * emit[x][1]
        pi = (a / (a + b), b / (a + b))
        states.append(int(pi[1] - pi[0] > 1e-12))
    return states


HMM = [segment.HmmParams(0, 0.9, 0.8, 0.8, 0.5, 0.9), segment.HmmParams(1, 0.2, 0.1, 0.3, 0.9, 1.0),
       segment.HmmParams(2, 0.99, 0.95, 0.9, 0.4, 0.5), segment.HmmParams(3, 0.6, 0.6, 0.5, 0.9, 0.0),
       segment.HmmParams(4, 0.1, 0.1, 0.1, 0.2, 1.0), segment.HmmParams(5, 0.999, 0.99, 0.95, 0.3, 1.0)]


def stretches_of(states):
    out, start = [], None
    for i, s in enumerate([*states, 0]):
        if s and start is None:
            start = i
        elif not s and start is not None:
            out.append((start, i))
            start = None
    return out


@pytest.mark.parametrize("seed,tile", [(1, 37), (2, 1), (3, 5000), (4, 64)])
def test_segmentation_matches_per_base_loop(spark, seed, tile):
    r = random.Random(seed)
    lengths = {"c1": 700, "c2": 90}
    symbols = {}
    for c, n in lengths.items():
        x, run = [], 0
        while len(x) < n:
            run = r.choice([1, 1, 2, 5, 30])
            x += [r.choice([0, 0, 1])] * run
        symbols[c] = x[:n]
    pos = spark.createDataFrame([(c, i, i + 1) for c, x in symbols.items() for i, s in enumerate(x) if s], IV)
    chromes = spark.createDataFrame(list(lengths.items()), "chrom string, length long")
    out = segment.hmm_segment(pos, chromes, HMM, tile_width=tile)
    want = sorted((p.param_id, c, s, e, sum(symbols[c][s:e])) for p in HMM for c in lengths
                  for s, e in stretches_of(hmm_loop(symbols[c], p)))
    assert got(out, "param_id", "chrom", "start", "end", "num_conserved") == want


def test_segmentation_takes_runs_and_can_carry_over(spark):
    runs = spark.createDataFrame([("c1", 3, 9), ("c1", 9, 12), ("c2", 0, 4)], IV)
    chromes = spark.createDataFrame([("c1", 12, 1), ("c2", 10, 2)], "chrom string, length long, ord int")
    p = HMM[:1]
    x1, x2 = [0] * 3 + [1] * 9, [1] * 4 + [0] * 6
    fresh = [("c1", *s) for s in stretches_of(hmm_loop(x1, p[0]))] + [("c2", *s) for s in stretches_of(hmm_loop(x2, p[0]))]
    assert got(segment.hmm_segment(runs, chromes, p, tile_width=4), "chrom", "start", "end") == fresh
    joint = hmm_loop(x1 + x2, p[0])
    carried = [("c1", *s) for s in stretches_of(joint[:12])] + [("c2", *s) for s in stretches_of(joint[12:])]
    assert got(segment.hmm_segment(runs, chromes, p, carry=True, tile_width=4), "chrom", "start", "end") == carried


def test_elements_drop_open_ends(spark):
    s = spark.createDataFrame([(0, "c", 0, 30, 5, False, True), (0, "c", 40, 90, 9, True, True), (0, "c", 95, 100, 5, True, False)],
                              "param_id int, chrom string, start long, end long, num_conserved long, opened boolean, closed boolean")
    assert got(segment.hmm_elements(s), "start", "length_class") == [(40, "kept")]
    assert got(segment.hmm_elements(s, open_at_start=True), "start") == [(0,), (40,)]


def fetch_loop(blocks, region, dist):
    """Straight fold over blocks in order, one list of copies per (species, scaffold)."""
    chrom, rs, re_ = region
    copies = {}
    for b in sorted((b for b in blocks if b[0] == chrom and b[1] < re_ and b[1] + b[2] > rs), key=lambda b: b[1]):
        lo, hi = max(rs, b[1]), min(re_, b[1] + b[2])
        used = set()
        for sp, sc, src, text in b[3]:
            mine = copies.setdefault((sp, sc), [])
            piece, last = text[lo - b[1]: hi - b[1]], src + len(text.replace("-", ""))
            for c in mine:
                if id(c) not in used and abs(c["last"] - src) < dist:
                    break
            else:
                c = {"src": src + lo - b[1], "seq": ""}
                mine.append(c)
            c["seq"] = c["seq"].ljust(lo - rs, "-") + piece
            c["last"] = last
            used.add(id(c))
    return sorted((sp, sc, i, c["src"], c["seq"].ljust(re_ - rs, "-")) for (sp, sc), cs in copies.items() for i, c in enumerate(cs))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_region_fetch_matches_a_fold(spark, seed):
    r = random.Random(seed)
    blocks, at, src = [], 0, {"a": 0, "b": 500}
    for _ in range(12):
        n = r.randint(3, 9)
        text = lambda: "".join(r.choice("ACGT-") for _ in range(n))
        rows = [("ref", "c", at, "".join(r.choice("ACGT") for _ in range(n)))]
        for sp in "ab":
            for _ in range(r.choice([0, 1, 1, 2])):
                src[sp] += r.choice([0, 3, 8, 150, -120])
                rows.append((sp, r.choice(["s1", "s1", "s2"]), abs(src[sp]), text()))
        blocks.append(("c", at, n, rows))
        at += n + (5 if r.random() < 0.2 else 0)
    schema = ("block_id long, chrom string, start long, size long, rows array<struct<species:string,scaffold:string,"
              "start:long,size:long,strand:string,src_size:long,text:string>>")
    df = spark.createDataFrame([(i, c, s, n, [(sp, sc, p, len(t.replace("-", "")), "+", 10**4, t) for sp, sc, p, t in rows])
                                for i, (c, s, n, rows) in enumerate(blocks)], schema)
    regions = [("c", 0, at), ("c", 4, 15), ("c", 20, 41)]
    out = alignment.fetch_regions(df, spark.createDataFrame(regions, IV))
    for reg in regions:
        part = out.where((out.start == reg[1]) & (out.end == reg[2]))
        assert got(part, "species", "scaffold", "copy", "src_start", "seq") == fetch_loop(blocks, reg, 100)


def test_batches_of_loci(spark):
    loci = [("c1", i * 100, i * 100 + 10 + i, f"n{i:03d}") for i in range(45)]
    out = alignment.batch_loci(spark.createDataFrame(loci, f"{IV}, name string"), 20, tile_width=256)
    rows = got(out, "batch_id", "idx", "start", "end", "name")
    assert [r[0] for r in rows] == [1] * 20 + [2] * 20 + [3] * 5 and [r[1] for r in rows] == list(range(45))
    assert all(a[3] == b[2] for a, b in zip(rows, rows[1:]) if a[0] == b[0]) and rows[20][2] == 0


def test_fourfold_columns_by_hand(spark):
    rows = [("ref", "c", 0, 9, "+", 9, "CTAATGGGT"), ("x", "s", 0, 9, "+", 9, "CTCATGG-T")]
    schema = ("block_id long, chrom string, start long, size long, rows array<struct<species:string,scaffold:string,"
              "start:long,size:long,strand:string,src_size:long,text:string>>")
    b = spark.createDataFrame([(1, "c", 0, 9, rows)], schema)
    gff = spark.createDataFrame([("c", "CDS", 1, 9, "+", "0")], "seqid string, type string, start long, end long, strand string, phase string")
    # codons CTA (free), ATG (fixed), GGT (free)
    assert got(patterns.fourfold_columns(b, gff, ["ref", "x", "y"])) == [("c", 2, "AC*"), ("c", 8, "TT*")]


def test_fourfold_codons_cross_blocks_and_exons(spark):
    """Random genes of one to five exons on both strands over blocks of 7 bases, some with reference gaps, against a walk
    along each transcript."""
    r = random.Random(5)
    ref, other = ("".join(r.choice("ACGT") for _ in range(400)) for _ in "ab")
    schema = ("block_id long, chrom string, start long, size long, rows array<struct<species:string,scaffold:string,"
              "start:long,size:long,strand:string,src_size:long,text:string>>")
    blocks, hole = [], 21 * 7
    for s in range(0, 400, 7):
        if s == hole:
            continue
        a, b = ref[s:s + 7], other[s:s + 7]
        if r.random() < 0.3:
            a, b = a[:3] + "--" + a[3:], b[:3] + "GG" + b[3:]
        blocks.append((s, "c", s, len(ref[s:s + 7]), [("ref", "c", s, 7, "+", 400, a), ("x", "y", s, 7, "+", 400, b)]))
    genes, want = [], set()
    for g in range(30):
        cuts = sorted(r.sample(range(400), 2 * r.randint(1, 5)))
        exons = [(s, e) for s, e in zip(cuts[::2], cuts[1::2])]
        strand = r.choice("+-")
        read = exons if strand == "+" else exons[::-1]
        lead = r.randint(0, 2) if read[0][1] - read[0][0] > 2 else 0
        done, bases = 0, []
        for s, e in read:
            genes.append(("c", "CDS", s + 1, e, strand, str((lead - done) % 3), f"ID=cds{g};Parent=t{g}"))
            done += e - s
            bases += range(s, e) if strand == "+" else range(e - 1, s - 1, -1)
        for i in range(lead, len(bases) - 2, 3):
            three = bases[i:i + 3]
            if any(hole <= p < hole + 7 for p in three):
                continue
            text = "".join(ref[p] if strand == "+" else dict(zip("ACGT", "TGCA"))[ref[p]] for p in three[:2])
            if text in patterns.FOURFOLD_PREFIXES:
                want.add(("c", three[2], ref[three[2]] + other[three[2]] + "*"))
    gff = spark.createDataFrame(genes, "seqid string, type string, start long, end long, strand string, phase string, attributes string")
    out = got(patterns.fourfold_columns(spark.createDataFrame(blocks, schema), gff, ["ref", "x", "none"]))
    assert out == sorted(want) and len(want) > 100


def test_blocks_are_put_together_and_none_is_dropped(spark):
    """Blocks of 1 to 9 bases, some with reference gaps, cut to features and joined up to 12 columns, against a loop."""
    r = random.Random(8)
    schema = ("block_id long, chrom string, start long, size long, rows array<struct<species:string,scaffold:string,"
              "start:long,size:long,strand:string,src_size:long,text:string>>")
    blocks, features, pieces = [], [], []
    for chrom in ("c", "d"):
        features += [(chrom, s, s + 11) for s in range(0, 300, 16)]
        at = 0
        while at < 300:
            n = r.randint(1, 9)
            text = "".join(r.choice("ACGT") for _ in range(n))
            ref = text[:n // 2] + "-" * r.choice([0, 0, 2]) + text[n // 2:]
            rows = [("ref", chrom, at, n, "+", 300, ref)] + [
                (x, "s", 0, n, "+", 300, "".join(r.choice("ACGT-") for _ in ref)) for x in ("x", "y") if r.random() < 0.5]
            no = len(blocks)
            blocks.append((no, chrom, at, n, rows))
            cols = [i for i, ch in enumerate(ref) if ch != "-"]
            for _, s, e in [f for f in features if f[0] == chrom and f[1] < at + n and at < f[2]]:
                lo, hi = cols[max(s, at) - at], cols[min(e, at + n) - 1 - at] + 1
                pieces.append((chrom, max(s, at), min(e, at + n), hi - lo, {x[0]: x[6][lo:hi] for x in rows}))
            at += n
    want, open_ = [], None
    for p in sorted(pieces, key=lambda p: p[:3]):
        if open_ is None or open_[0][0] != p[0] or sum(q[3] for q in open_) >= 12:
            open_ = []
            want.append(open_)
        open_.append(p)
    text = lambda g, s: "".join(p[4].get(s, "-" * p[3]) for p in g)
    want = sorted((g[0][0], g[0][1], g[-1][2], s, text(g, s)) for g in want for s in {s for p in g for s in p[4]})
    out = alignment.concat_blocks(spark.createDataFrame(blocks, schema), spark.createDataFrame(features, IV), 12, tile_width=32)
    rows = out.selectExpr("chrom", "start", "end", "inline(rows)")
    assert got(rows) == want


def test_codons_restart_where_phases_do_not_fit(spark):
    rows = [("c", "CDS", 1, 4, "+", "0", "Parent=t"), ("c", "CDS", 11, 15, "+", "1", "Parent=t"), ("c", "CDS", 21, 22, "+", "2", "Parent=t,u")]
    gff = spark.createDataFrame(rows, "seqid string, type string, start long, end long, strand string, phase string, attributes string")
    # 0-2 is whole, base 3 has no partner; 10 lies before the phase, 11-13 is whole, 14 goes on with 20 and 21
    assert got(patterns.codon_positions(gff)) == [("c", "+", 0, 1, 2), ("c", "+", 11, 12, 13), ("c", "+", 14, 20, 21)]


def test_grid_exceedance_matches_nested_loop(spark):
    r = random.Random(2)
    data = [(r.uniform(-8, 8), float(r.randint(-8, 8))) for _ in range(80)]
    out = grid.grid_exceedance(spark.createDataFrame(data, "logbf1 double, logbf2 double"), -5, 5)
    want = sorted((a, b, sum(x > a and y > b for x, y in data)) for a in range(-5, 6) for b in range(-5, 6))
    assert got(out) == want


def test_param_grid(spark):
    g = grid.param_grid(spark, chrom=["a", "b"], size=[1, 2, 3])
    assert g.count() == 6 and g.columns == ["chrom", "size"]


def test_missing_chromosomes_are_errors(spark):
    from basetide.operators import segment

    sites = spark.createDataFrame([("c1", 5, 6), ("c9", 7, 8)], "chrom string, start long, end long")
    index = spark.createDataFrame([("c1", 100)], "chrom string, length long")
    for build in (lambda: intervals.occupied_windows(sites, index, 10), lambda: stats.uniform_null(sites, index),
                  lambda: segment.hmm_tiles(sites, index, tile_width=16)):
        with pytest.raises(Exception, match="not in the index: c9"):
            build().collect()
    beyond = spark.createDataFrame([("c1", 500, 501)], "chrom string, start long, end long")
    with pytest.raises(Exception, match="behind the end"):
        segment.hmm_tiles(beyond, index, tile_width=16).collect()


def test_cycles_are_errors(spark):
    from basetide.operators import tree

    nodes = spark.createDataFrame([(1, "a", "b"), (1, "b", "c"), (1, "c", "a")], "tree_id int, node string, parent string")
    with pytest.raises(ValueError):
        tree.ancestor_pairs(nodes)


def test_reference_gaps_are_refused(spark):
    row = "struct<species:string,scaffold:string,start:bigint,size:bigint,strand:string,src_size:bigint,text:string>"
    blocks = spark.createDataFrame([("c1", 0, 6, [("ref", "c1", 0, 6, "+", 100, "AC--GTTA"), ("x", "s", 0, 8, "+", 100, "ACTTGTTA")])],
                                   f"chrom string, start long, size long, rows array<{row}>")
    regions = spark.createDataFrame([("c1", 0, 6)], "chrom string, start long, end long")
    with pytest.raises(Exception, match="reference gaps"):
        alignment.fetch_regions(blocks, regions).collect()


def test_histogram_bins_edges(spark):
    from basetide.operators import intervals

    df = spark.createDataFrame([("a", 0.0), ("a", 2.4), ("b", 2.5), ("b", 10.0), ("b", None)], "k string, x double")
    got = sorted(tuple(r) for r in intervals.histogram_bins(df, "x", 4, ["k"]).collect())
    assert got == [("a", 0, 2, 0.0), ("b", 1, 1, 2.5), ("b", 3, 1, 7.5)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [tuple(r) for r in intervals.histogram_bins(same, "x", 4).collect()] == [(0, 2, 3.0)]
    assert intervals.histogram_bins(df.where("x is null"), "x", 4).count() == 0


def test_sets_side_by_side_equal_sets_alone():
    import numpy as np
    from basetide.operators import segment

    rng = np.random.default_rng(3)
    sets = [segment.HmmParams(i, *rng.uniform(0.3, 0.99, 4), 0.9) for i in range(segment.MANY_SETS + 4)]
    models, lo = segment._Models(sets), np.sort(rng.choice(900, 120, replace=False))
    edges, symbol = segment._tile_runs(0, 1000, lo, lo + 1, True)
    power = np.diff(edges)
    main, rest, ratio = models.runs(slice(None), symbol, True)
    full, entry = main + (ratio**power)[:, :, None, None] * rest, np.full((len(sets), 2), 0.5)
    together = segment._entering(full, entry)
    alone = np.concatenate([segment._entering(full[i:i + 1], entry[i:i + 1]) for i in range(len(sets))])
    assert np.allclose(together, alone, rtol=0, atol=1e-13)


def test_columns_are_the_transposed_rows(spark):
    from basetide.functions.sequences import columns_of

    rows = [["AC-T", "ACGT", "n*GT"], [""], ["日é😀x", "abcd"], ["A"]]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, t array<string>")
    assert [r.c for r in df.select("k", columns_of("t").alias("c")).orderBy("k").collect()] == [["".join(c) for c in zip(*r)] for r in rows]
