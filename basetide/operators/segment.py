"""Two-state forward-filter segmentation of chromosomes into conserved elements.

Every base emits 1 (conserved) or 0. The filter update is linear up to scale, pi <- A_x pi with
A_x = diag(emit[:, x]) T', so the product of the A's over a stretch of bases is one 2x2 matrix.
Chromosomes are cut into position tiles: pass 1 reduces each tile to its matrix, a short prefix over
the tiles of a chromosome gives the distribution entering each tile, pass 2 finds the state inside
the tile. Within a run of equal symbols A^k = l1^k (P1 + r^k P2) with |r| < 1, so the state is read
off in closed form and no loop visits single bases.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.operators.intervals import indexed_length, _explode_range, length_filter, make_windows, merge_intervals
from basetide.plans.lineage import cut
from basetide.plans.ordered import TILE_WIDTH, Scan, ordered_scan, position_tile

LOW, HIGH = 1e-10, 0.9999999999
TIE = 1e-12
#: Sets times runs worked on at once, sets from which runs are walked for all sets together, rows of a frame that is sent on.
SET_CELLS, MANY_SETS, FRAME_ROWS = 250_000, 16, 100_000
#: Blocks of sets that walk through a tile together, and the longest run whose powers are kept while they do.
WALKED_BLOCKS, KEPT_POWERS = 32, 512


@dataclass(frozen=True)
class HmmParams:
    """Stay probabilities outside / inside, emission of 0 outside and of 1 inside, start outside."""

    param_id: int
    t0_0: float
    t1_1: float
    e0_0: float
    e1_1: float
    s0: float

    def clamped(self) -> tuple[float, ...]:
        return tuple(min(max(v, LOW), HIGH) for v in (self.t0_0, self.t1_1, self.e0_0, self.e1_1, self.s0))


class _Model:
    """Spectral form of the two update matrices of one parameter set."""

    def __init__(self, p: HmmParams):
        t0, t1, e0, e1, s0 = p.clamped()
        step = np.array([[t0, 1 - t1], [1 - t0, t1]])
        self.emit = np.array([[e0, 1 - e1], [1 - e0, e1]])
        self.start = np.array([s0, 1 - s0])
        mats = self.emit[:, :, None] * step
        half = (mats[:, 0, 0] - mats[:, 1, 1]) / 2
        mid = (mats[:, 0, 0] + mats[:, 1, 1]) / 2
        root = np.sqrt(half**2 + mats[:, 0, 1] * mats[:, 1, 0])
        big, small = mid + root, mid - root
        eye = np.eye(2)
        self.main = (mats - small[:, None, None] * eye) / (2 * root)[:, None, None]
        self.rest = (big[:, None, None] * eye - mats) / (2 * root)[:, None, None]
        self.ratio = small / big


class _Models:
    """Parameter sets side by side: the first axis of every array is the set."""

    def __init__(self, params: Sequence[HmmParams]):
        each = [_Model(p) for p in params]
        self.ids = np.array([p.param_id for p in params], dtype=np.int64)
        self.main, self.rest = np.stack([m.main for m in each]), np.stack([m.rest for m in each])
        self.ratio = np.stack([m.ratio for m in each])
        self.opening = np.stack([m.start * m.emit for m in each])

    def parts(self, n_runs: int) -> Iterator[slice]:
        """Ranges of sets whose matrices over ``n_runs`` runs stay within a fixed size."""
        step = max(1, SET_CELLS // max(n_runs, 1))
        return (slice(i, i + step) for i in range(0, len(self.ids), step))

    def runs(self, which: slice | np.ndarray, symbol: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(P1, P2, r) of every set and run; the very first base of a chromosome replaces the update by
        start * emission, whatever comes in."""
        main, rest, ratio = self.main[which][:, symbol], self.rest[which][:, symbol], self.ratio[which][:, symbol]
        if first:
            v = self.opening[which][:, symbol[0]]
            main[:, 0], rest[:, 0], ratio[:, 0] = np.stack([v, v], axis=2), 0.0, 0.0
        return main, rest, ratio


def _tile_runs(start: int, end: int, lo: np.ndarray, hi: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Run edges (n + 1 positions) and symbols of a tile with sorted conserved pieces [lo, hi)."""
    if lo.size:
        reach = np.maximum.accumulate(hi)
        fresh = np.r_[True, lo[1:] > reach[:-1]]
        lo, hi = lo[fresh], reach[np.r_[fresh[1:], True]]
    edges = np.empty(2 * lo.size + 2, dtype=np.int64)
    edges[0], edges[1:-1:2], edges[2:-1:2], edges[-1] = start, lo, hi, end
    symbol = np.arange(2 * lo.size + 1) % 2
    full = edges[1:] > edges[:-1]
    edges, symbol = np.r_[edges[:-1][full], end], symbol[full]
    if first and edges[1] - edges[0] > 1:
        edges, symbol = np.r_[edges[0], edges[0] + 1, edges[1:]], np.r_[symbol[0], symbol]
    return edges, symbol


def _product(mats: np.ndarray) -> np.ndarray:
    """Later matrices times earlier ones for every set, pairwise, rescaled on the way."""
    while mats.shape[1] > 1:
        odd = mats[:, -1:] if mats.shape[1] % 2 else mats[:, :0]
        even = mats[:, : mats.shape[1] - odd.shape[1]]
        mats = np.concatenate([even[:, 1::2] @ even[:, 0::2], odd], axis=1)
        mats = mats / mats.max(axis=(2, 3), keepdims=True)
    return mats[:, 0]


def _entering(full: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """The distribution in front of every run, (sets, runs, 2), from the one in front of the tile."""
    out = np.empty(full.shape[:3])
    if len(full) >= MANY_SETS:
        v = entry
        for i in range(full.shape[1]):
            out[:, i] = v
            v = np.einsum("sjk,sk->sj", full[:, i], v)
            v = v / v.sum(axis=1, keepdims=True)
        return out
    for s, mats in enumerate(full.reshape(len(full), -1, 4).tolist()):
        a, b = entry[s].tolist()
        for i, (m00, m01, m10, m11) in enumerate(mats):
            out[s, i] = a, b
            a, b = m00 * a + m01 * b, m10 * a + m11 * b
            total = a + b
            a, b = a / total, b / total
    return out


def _state_pieces(main: np.ndarray, rest: np.ndarray, ratio: np.ndarray, edges: np.ndarray, symbol: np.ndarray,
                  entries: np.ndarray) -> tuple[np.ndarray, ...]:
    """(set, start, end, state, symbol) of pieces that cover the tile once per set, in order, for all sets at once.

    Inside a run the state after k bases is 1 iff lead + drift * r^k > 0. Where r is positive that changes once at most, at the
    crossing of both terms; where it is negative single bases are looked at up to the crossing, behind it nothing changes.
    """
    length = np.diff(edges)
    weight = np.array([-1 - TIE, 1 - TIE])
    lead = np.einsum("j,srjk,srk->sr", weight, main, entries)
    drift = np.einsum("j,srjk,srk->sr", weight, rest, entries)
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = np.log(np.abs(lead / drift)) / np.log(np.abs(ratio))
    cross = np.where(np.isfinite(cross), cross, np.where(drift == 0, 0, length))
    cross = np.clip(np.ceil(cross), 0, length).astype(np.int64)

    def state(at: tuple, k: np.ndarray) -> np.ndarray:
        """State of base k (from 0) of the cells ``at``."""
        return lead[at] + drift[at] * ratio[at] ** (k + 1) > 0

    cells = np.indices(lead.shape)
    everywhere = (cells[0], cells[1])
    last = np.broadcast_to(length - 1, lead.shape)
    opening, closing = state(everywhere, np.zeros_like(last)), state(everywhere, last)
    flips = (ratio < 0) & (cross > 0) & (last > 0)
    # cells that change once: the first base near the crossing that has the last one's state
    turn = np.nonzero(~flips & (opening != closing))
    turned = last[turn].copy()
    for shift in (1, 0, -1):
        k = np.clip(cross[turn] + shift, 1, last[turn])
        turned = np.where(state(turn, k) == closing[turn], np.minimum(turned, k), turned)
    n = np.ones(lead.shape, np.int64)
    n[turn] = 2
    n[flips] = np.minimum(cross + 2, length)[flips]
    # lay out the pieces of all cells, in (set, run, base) order
    flat = n.ravel()
    first = np.cumsum(flat) - flat
    cell = np.repeat(np.arange(flat.size), flat)
    k = np.arange(len(cell)) - first[cell]
    k[first[np.ravel_multi_index(turn, lead.shape)] + 1] = turned
    which = np.unravel_index(cell, lead.shape)
    begin = edges[which[1]] + k
    end = np.empty_like(begin)
    end[:-1] = begin[1:]
    closes = first + flat - 1
    end[closes] = edges[1:][np.arange(flat.size) % lead.shape[1]]
    return which[0], begin, end, state(which, k), symbol[which[1]]


def _conserved_stretches(*cells) -> tuple[np.ndarray, ...]:
    """(set, start, end, conserved bases) of the stretches of a tile that are in state 1."""
    owner, begin, end, inside, symbol = _state_pieces(*cells)
    hits = np.flatnonzero(inside)
    if not hits.size:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    opens = np.r_[True, (np.diff(hits) > 1) | (np.diff(owner[hits]) > 0)]
    counted = np.add.reduceat((end - begin)[hits] * symbol[hits], np.flatnonzero(opens))
    return owner[hits[opens]], begin[hits[opens]], end[hits[np.r_[opens[1:], True]]], counted


def hmm_tiles(sites: DataFrame, chromes: DataFrame, carry: bool = False, tile_width: int = TILE_WIDTH) -> DataFrame:
    """One row per position tile: its range, its sorted conserved pieces and whether the filter
    starts there. A tile of W bases holds at most W distinct 1-bp sites or W / 2 disjoint runs."""
    cut = _explode_range(sites.select("chrom", "start", "end"), F.floor(F.col("start") / tile_width),
                         F.floor((F.col("end") - 1) / tile_width), "tile")
    base = F.col("tile") * tile_width
    pieces = cut.select("chrom", "tile", F.greatest("start", base).alias("s"),
                        F.least("end", base + tile_width).alias("e")).distinct()
    pieces = pieces.groupBy("chrom", "tile").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("p"))
    inside = indexed_length(pieces, chromes)
    outside = F.raise_error(F.concat(F.lit("sites behind the end of chromosome "), "chrom"))
    pieces = inside.withColumn("p", F.when(F.col("tile") * tile_width < F.col("length"), F.col("p")).otherwise(
        outside.cast(pieces.schema["p"].dataType))).drop("length")
    tiles = make_windows(chromes, tile_width).withColumnRenamed("window_no", "tile")
    if carry and "ord" not in chromes.columns:
        raise ValueError("carry needs an `ord` column in chromes")
    if carry:
        first_chrom = chromes.where(F.col("length") > 0).agg(F.min("ord").alias("_first")).withColumn("_one", F.lit(1))
        tiles = (tiles.join(chromes.select("chrom", "ord"), "chrom").withColumn("_one", F.lit(1)).join(first_chrom, "_one")
                 .withColumn("reset", (F.col("tile") == 0) & (F.col("ord") == F.col("_first"))).drop("_one", "_first"))
    else:
        tiles = tiles.withColumn("ord", F.lit(0)).withColumn("reset", F.col("tile") == 0)
    empty = F.array().cast("array<bigint>")
    return (tiles.join(pieces, ["chrom", "tile"], "left")
            .select("chrom", "ord", "tile", "start", "end", "reset",
                    F.coalesce(F.transform("p", lambda x: x["s"]), empty).alias("lo"),
                    F.coalesce(F.transform("p", lambda x: x["e"]), empty).alias("hi")))


def _tuples(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    return (row for pdf in batches for row in pdf.itertuples(index=False, name=None))


def _in_frames(work):
    """Put the many small frames of ``work`` together into frames of some ``FRAME_ROWS`` rows."""

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for frame in work(batches):
            held.append(frame)
            rows += len(frame)
            if rows >= FRAME_ROWS or len(held) >= 1000:
                yield pd.concat(held)
                held, rows = [], 0
        if held:
            yield pd.concat(held)

    return gathered


def _field(array: str, name: str) -> Column:
    return F.transform(array, lambda x: x[name]).alias(name)


def hmm_segment(sites: DataFrame, chromes: DataFrame, params: Sequence[HmmParams], carry: bool = False,
                tile_width: int = TILE_WIDTH) -> DataFrame:
    """Stretches in state 1: (param_id, chrom, start, end, num_conserved, opened, closed).

    ``opened`` is false for a stretch that begins at the first base, ``closed`` for one that reaches
    the chromosome end. Parameter sets are settings (a grid of thousands at most). The filter starts
    anew on every chromosome; ``carry`` runs it through all chromosomes in ``ord`` order.
    """
    models = _Models(params)
    place = {int(pid): i for i, pid in enumerate(models.ids)}
    tiles = hmm_tiles(sites, chromes, carry, tile_width)
    scope = ["param_id"] if carry else ["param_id", "chrom"]

    def reduce_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chrom, ord_, tile, start, end, reset, lo, hi in _tuples(batches):
            edges, symbol = _tile_runs(start, end, np.asarray(lo), np.asarray(hi), reset)
            length = np.diff(edges)
            for part in models.parts(len(length)):
                main, rest, ratio = models.runs(part, symbol, reset)
                m = _product(main + (ratio**length)[:, :, None, None] * rest)
                yield pd.DataFrame({"param_id": models.ids[part], "chrom": chrom, "ord": ord_, "tile": tile, "m00": m[:, 0, 0],
                                    "m01": m[:, 0, 1], "m10": m[:, 1, 0], "m11": m[:, 1, 1]})

    def enter_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for pid, names, tile_no, *entries in pdf.itertuples(index=False):
                v = np.array([0.5, 0.5])
                for chrom, tile, m in zip(names, tile_no, np.stack(entries, axis=1)):
                    rows.append((pid, chrom, tile, *v.tolist()))
                    v = m.reshape(2, 2) @ v
                    v = v / v.sum()
            yield pd.DataFrame(rows, columns=["param_id", "chrom", "tile", "v0", "v1"])

    def walk_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chrom, start, end, reset, lo, hi, ids, v0, v1 in _tuples(batches):
            edges, symbol = _tile_runs(start, end, np.asarray(lo), np.asarray(hi), reset)
            length = np.diff(edges)
            sets, entry = np.array([place[int(pid)] for pid in ids]), np.stack([v0, v1], axis=1)
            for part in models.parts(len(length)):
                chosen = sets[part]
                if not chosen.size:
                    continue
                main, rest, ratio = models.runs(chosen, symbol, reset)
                entries = _entering(main + (ratio**length)[:, :, None, None] * rest, entry[part])
                who, s, e, n = _conserved_stretches(main, rest, ratio, edges, symbol, entries)
                yield pd.DataFrame({"param_id": models.ids[chosen][who], "chrom": chrom, "start": s, "end": e, "num_conserved": n})

    matrices = tiles.mapInPandas(_in_frames(reduce_tiles), "param_id int, chrom string, ord int, tile long, "
                                               "m00 double, m01 double, m10 double, m11 double")
    # at most length / tile_width tiles per chromosome and parameter set
    lines = matrices.groupBy(*scope).agg(F.sort_array(F.collect_list(
        F.struct("ord", "tile", "chrom", "m00", "m01", "m10", "m11"))).alias("m"))
    entering = lines.select("param_id", *[_field("m", c)
                                          for c in ("chrom", "tile", "m00", "m01", "m10", "m11")])
    entering = entering.mapInPandas(enter_tiles, "param_id int, chrom string, tile long, v0 double, v1 double")
    per_tile = entering.groupBy("chrom", "tile").agg(F.collect_list(F.struct("param_id", "v0", "v1")).alias("v"))
    walked = tiles.join(per_tile, ["chrom", "tile"]).select(
        "chrom", "start", "end", "reset", "lo", "hi",
        *[_field("v", c) for c in ("param_id", "v0", "v1")])
    pieces = cut(walked.mapInPandas(_in_frames(walk_tiles), "param_id int, chrom string, start long, end long, num_conserved long"))
    whole = merge_intervals(pieces, 0, keys=("param_id", "chrom"), sums=("num_conserved",), tile_width=tile_width)
    return (indexed_length(whole, chromes)
            .select("param_id", "chrom", "start", "end", "num_conserved", (F.col("start") > 0).alias("opened"),
                    (F.col("end") < F.col("length")).alias("closed")))


def hmm_elements(stretches: DataFrame, min_len: int = 20, max_len: int = 10000,
                 open_at_start: bool = False) -> DataFrame:
    """Elements with length, conserved share and length class. A stretch still open at the
    chromosome end is no element; one that begins at the first base is one only on request."""
    kept = stretches.where("closed") if open_at_start else stretches.where("opened and closed")
    out = length_filter(kept.drop("opened", "closed"), min_len, max_len)
    return out.withColumn("density", F.col("num_conserved") / F.col("length"))


def hmm_summary(stretches: DataFrame, sites: DataFrame, chromes: DataFrame, params: Iterable[HmmParams],
                min_len: int = 20, max_len: int = 10000, tile_width: int = TILE_WIDTH) -> DataFrame:
    """One report row per (parameter set, chromosome). Stretches that opened count as elements even
    when still open at the end; means divide by the final count and are 0 when there is none."""
    keys = ["param_id", "chrom"]
    classed = length_filter(stretches, min_len, max_len)
    ok = F.col("opened") & F.col("closed")
    kept = classed.where(ok & (F.col("length_class") == "kept")).withColumn("_tile", position_tile("start", tile_width))
    spaced = ordered_scan(kept, keys, "start", "_tile", [Scan("_prev_end", "last", "end", inclusive=False)])
    stats = spaced.groupBy(*keys).agg(
        F.sum("length").alias("_len"), F.sum(F.col("start") - F.col("_prev_end")).alias("_gap"),
        F.sum("num_conserved").alias("sites_in_elements"),
        F.sum(F.col("num_conserved") / F.col("length")).alias("_dens"))
    counts = classed.groupBy(*keys).agg(
        F.count(F.when(F.col("opened"), 1)).alias("total_elements"),
        F.count(F.when(ok & (F.col("length_class") == "short"), 1)).alias("too_short"),
        F.count(F.when(ok & (F.col("length_class") == "long"), 1)).alias("too_long"))
    return _report(counts.join(stats, keys, "left"), sites, chromes, params, min_len)


def _report(sums: DataFrame, sites: DataFrame, chromes: DataFrame, params: Iterable[HmmParams], min_len: int) -> DataFrame:
    """The report rows from counts and sums per (parameter set, chromosome)."""
    keys = ["param_id", "chrom"]
    covered = sites.select("chrom", "start", "end").distinct().groupBy("chrom").agg(
        F.sum(F.col("end") - F.col("start")).alias("conserved_sites"))
    fields = ("t0_0", "t1_1", "e0_0", "e1_1", "s0")
    rows = [(i, p.param_id, *map(float, p.clamped())) for i, p in enumerate(params)]
    settings = chromes.sparkSession.createDataFrame(rows, "_i int, param_id int, " + ", ".join(f"{n} double" for n in fields))
    # every chromosome with every set; the table of sets is a setting, thousands of rows at most
    report = (chromes.select("chrom", "length", F.explode(F.sequence(F.lit(0), F.lit(len(rows) - 1))).alias("_i"))
              .join(F.broadcast(settings), "_i").drop("_i"))
    out = (report.join(covered, "chrom", "left").join(sums, keys, "left")
           .na.fill(0, ["conserved_sites", "total_elements", "too_short", "too_long", "_len", "_gap",
                        "sites_in_elements", "_dens"]))
    final = F.col("total_elements") - F.col("too_short") - F.col("too_long")

    def mean(col: str):
        return F.when(final > 0, F.col(col) / final).otherwise(F.lit(0.0))

    return out.select("param_id", "chrom", "length", "conserved_sites", "total_elements", "too_short", "too_long",
                      final.alias("final_elements"), mean("_len").alias("mean_length"), mean("_gap").alias("mean_gap"),
                      "sites_in_elements", mean("_dens").alias("mean_density"), *fields, F.lit(min_len).alias("min_len"))


#: What a tile tells about each set: end and conserved bases of the stretch at its start (end = start: none), start and
#: conserved bases of another one at its end (start = end: none), then counts and sums over the stretches between.
PARTS = ("head_end", "head_n", "tail_start", "tail_n", "total", "short", "long", "len", "gap", "n", "dens", "first", "last")
_TOTALS = {"total_elements": "total", "too_short": "short", "too_long": "long", "_len": "len", "_gap": "gap", "sites_in_elements": "n",
           "_dens": "dens"}


def _tile_parts(n_sets: int, start: int, end: int, found: tuple[np.ndarray, ...], min_len: int, max_len: int) -> np.ndarray:
    """(len(PARTS), sets) of a tile from its stretches; ``first`` and ``last`` are the start and the end of the outer kept ones,
    -1 without any."""
    who, s, e, n = found
    out = np.zeros((len(PARTS), n_sets))
    out[0], out[2], out[11], out[12] = start, end, -1, -1
    head = s == start
    out[0, who[head]], out[1, who[head]] = e[head], n[head]
    tail = (e == end) & ~head
    out[2, who[tail]], out[3, who[tail]] = s[tail], n[tail]
    inner = ~head & ~tail
    who, s, e, n = who[inner], s[inner], e[inner], n[inner]
    length = e - s
    short, long = length <= min_len, (length >= max_len) & (length > min_len)
    kept = ~short & ~long

    def count(rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(who[rows], None if weights is None else weights[rows], n_sets)

    out[4], out[5], out[6] = count(slice(None)), count(short), count(long)
    out[7], out[9], out[10] = count(kept, length), count(kept, n), count(kept, n / length)
    w, s, e = who[kept], s[kept], e[kept]
    if len(w):
        same = w[1:] == w[:-1]
        out[8] = np.bincount(w[1:][same], (s[1:] - e[:-1])[same], n_sets)
        opens, closes = np.r_[True, ~same], np.r_[~same, True]
        out[11, w[opens]], out[12, w[closes]] = s[opens], e[closes]
    return out


class _Walk:
    """Many sets side by side over the runs of one tile: every step works on one array per quantity, with an entry for each set.

    Between the eigenvectors of its symbol a run of k bases shrinks one part of the filter by ratio^k, so the states of the run follow
    from how many bases the shrinking part outweighs the lasting one. Up to there a positive ratio keeps one state and
    a negative one alternates; both are laid down as a first piece, single bases and a last piece, without a row per piece.
    Sets of negative ratio stand behind the others (``order``).
    """

    def __init__(self, models: _Models, ids: np.ndarray, min_len: int, max_len: int):
        self.order = np.argsort(models.ratio[ids, 0] < 0, kind="stable")
        ids = ids[self.order]
        self.n, self.positive = len(ids), int((models.ratio[ids, 0] >= 0).sum())
        self.min_len, self.max_len = min_len, max_len
        self.main = [[np.ascontiguousarray(models.main[ids, x, i, j]) for i in (0, 1) for j in (0, 1)] for x in (0, 1)]
        self.opening = [[np.ascontiguousarray(models.opening[ids, x, i]) for i in (0, 1)] for x in (0, 1)]
        self.ratio = [np.ascontiguousarray(models.ratio[ids, x]) for x in (0, 1)]
        with np.errstate(divide="ignore"):
            self.log_ratio = [np.log(np.abs(r)) for r in self.ratio]
        self.largest = [float(np.abs(r).max()) for r in self.ratio]
        self.powers: dict[tuple[int, int], np.ndarray] = {}

    def _power(self, x: int, length: int) -> np.ndarray | None:
        """ratio^length; none where nothing of it is left. Powers of short runs are kept."""
        if self.largest[x] ** length < 1e-100:
            return None
        known = self.powers.get((x, length))
        if known is None:
            known = self.ratio[x] ** length
            if length <= KEPT_POWERS:
                self.powers[x, length] = known
        return known

    def product(self, edges: np.ndarray, symbol: np.ndarray, first: bool) -> np.ndarray:
        """The matrices of the tile, (sets, 2, 2), up to scale."""
        a, b = np.zeros((2, self.n)), np.zeros((2, self.n))  # rows of the matrix; their first axis is its column
        a[0], b[1] = 1.0, 1.0
        for i, (x, length) in enumerate(zip(symbol.tolist(), np.diff(edges).tolist())):
            if first and i == 0:
                total = a + b
                a, b = self.opening[x][0] * total, self.opening[x][1] * total
            else:
                m00, m01, m10, m11 = self.main[x]
                qa, qb = m00 * a + m01 * b, m10 * a + m11 * b
                power = self._power(x, length)
                if power is not None:
                    qa, qb = qa + power * (a - qa), qb + power * (b - qb)
                a, b = qa, qb
            scale = 1 / (a + b).max(axis=0)
            a, b = a * scale, b * scale
        out = np.empty((self.n, 2, 2))
        out[self.order, 0], out[self.order, 1] = a.T, b.T
        return out

    def parts(self, edges: np.ndarray, symbol: np.ndarray, first: bool, entry: np.ndarray) -> np.ndarray:
        """What ``_tile_parts`` gives, (len(PARTS), sets), from the distributions in front of the tile."""
        n, cut_at = self.n, self.positive
        self.start, end = int(edges[0]), int(edges[-1])
        self.out = {name: np.zeros(n) for name in PARTS}
        for name, value in (("head_end", self.start), ("tail_start", end), ("first", -1), ("last", -1)):
            self.out[name][:] = value
        self.open, self.begin, self.held = np.zeros(n, bool), np.zeros(n), np.zeros(n)
        a, b = (np.ascontiguousarray(v) for v in entry[self.order].T)
        nothing = np.zeros(n)
        for i, (x, lo, length) in enumerate(zip(symbol.tolist(), edges.tolist(), np.diff(edges).tolist())):
            if first and i == 0:
                total = a + b
                qa, qb = self.opening[x][0] * total, self.opening[x][1] * total
                ra = rb = nothing
            else:
                m00, m01, m10, m11 = self.main[x]
                qa, qb = m00 * a + m01 * b, m10 * a + m11 * b
                ra, rb = a - qa, b - qb
            lead = (1 - TIE) * qb - (1 + TIE) * qa
            drift = (1 - TIE) * rb - (1 + TIE) * ra
            settled, rising = lead > 0, drift > 0
            # bases in which the drift outweighs the lead; neither of both (nan): none
            with np.errstate(divide="ignore", invalid="ignore"):
                reach = np.ceil(np.log(np.abs(lead / drift)) / self.log_ratio[x]) - 1
            reach = np.minimum(np.fmax(reach, 0), length)
            self._run(x, lo, length, reach, settled, rising, cut_at)
            power = self._power(x, length)
            if power is not None:
                qa, qb = qa + power * ra, qb + power * rb
            scale = 1 / (qa + qb)
            a, b = qa * scale, qb * scale
        held = np.flatnonzero(self.open)
        through = self.begin[held] == self.start
        at, rest = held[through], held[~through]
        self.out["head_end"][at], self.out["head_n"][at] = end, self.held[at]
        self.out["tail_start"][rest], self.out["tail_n"][rest] = self.begin[rest], self.held[rest]
        kept = self.out["first"] >= 0  # the gaps between the kept ones are what these leave of their range
        self.out["gap"][kept] = (self.out["last"] - self.out["first"] - self.out["len"])[kept]
        parts = np.empty((len(PARTS), n))
        for i, name in enumerate(PARTS):
            parts[i, self.order] = self.out[name]
        return parts

    def _run(self, x: int, lo: int, length: int, reach: np.ndarray, settled: np.ndarray, rising: np.ndarray, cut_at: int) -> None:
        """The pieces of one run. ``before`` bases come in front of the last piece, which has state ``final``."""
        before, final, opens = np.where(settled != rising, reach, 0.0), settled.copy(), rising.copy()
        if cut_at < self.n:
            c, s1 = reach[cut_at:], ~rising[cut_at:]
            s_c = s1 ^ (c % 2 == 0)
            all_of_it = c == length
            joined = (c > 0) & (all_of_it | (s_c == settled[cut_at:]))
            before[cut_at:] = c - joined
            final[cut_at:] = np.where(joined, s_c, settled[cut_at:])
            opens[cut_at:] = s1
        some = np.flatnonzero(before > 0)
        if some.size:
            s = opens[some]
            self._close(some[self.open[some] & ~s], lo)
            fresh = some[s & ~self.open[some]]
            self.begin[fresh], self.held[fresh] = lo, 0
            self.open[some] = s
            if x:
                own = some[s]
                self.held[own] += np.where(own < cut_at, before[own], 1)
            singles = some[(some >= cut_at) & (before[some] > 1)]
            if singles.size:
                self._close(singles[self.open[singles]], lo + 1)
                self.open[singles] = False
                self._single_bases(x, lo, singles, before[singles], opens[singles])
        rest = before < length
        at = lo + before
        closed = np.flatnonzero(self.open & ~final & rest)
        self._close(closed, at[closed])
        fresh = np.flatnonzero(final & ~self.open & rest)
        self.begin[fresh], self.held[fresh] = at[fresh], 0
        self.open = np.where(rest, final, self.open)
        if x:
            self.held += np.where(final, length - before, 0)

    def _single_bases(self, x: int, lo: int, which: np.ndarray, last: np.ndarray, opens: np.ndarray) -> None:
        """Bases 2 to ``last`` of a run alternate; each of them in state 1 is a stretch."""
        lowest = np.where(opens, 3, 2)
        n = (last - lowest) // 2 + 1
        some = n > 0
        which, n, lowest = which[some], n[some], lowest[some]
        self.out["total"][which] += n
        if 1 <= self.min_len:
            self.out["short"][which] += n
        elif 1 >= self.max_len:
            self.out["long"][which] += n
        else:
            begin = lo + lowest - 1
            self._keep(which, begin, begin + 2 * n - 1, n, n * x, n * x)

    def _keep(self, which, begin, end, length, n, density) -> None:
        self.out["len"][which] += length
        self.out["n"][which] += n
        self.out["dens"][which] += density
        fresh = self.out["first"][which] < 0
        self.out["first"][which[fresh]] = begin[fresh]
        self.out["last"][which] = end

    def _close(self, which: np.ndarray, end: np.ndarray | int) -> None:
        """Stretches that end inside the tile."""
        if not which.size:
            return
        begin, end, n = self.begin[which], np.broadcast_to(end, which.shape), self.held[which]
        head = begin == self.start
        if head.any():
            at = which[head]
            self.out["head_end"][at], self.out["head_n"][at] = end[head], n[head]
            which, begin, end, n = which[~head], begin[~head], end[~head], n[~head]
        length = end - begin
        short = length <= self.min_len
        long = (length >= self.max_len) & ~short
        self.out["total"][which] += 1
        self.out["short"][which] += short
        self.out["long"][which] += long
        kept = ~short & ~long
        if kept.any():
            length, n = length[kept], n[kept]
            self._keep(which[kept], begin[kept], end[kept], length, n, n / length)


class _Folded:
    """Counts and sums of all sets over the tiles of a chromosome so far, and the stretch that is still open."""

    def __init__(self, n_sets: int, min_len: int, max_len: int):
        self.min_len, self.max_len = min_len, max_len
        self.sums = dict.fromkeys(_TOTALS.values())
        for k in self.sums:
            self.sums[k] = np.zeros(n_sets)
        self.open, self.begin, self.n, self.last = np.zeros(n_sets, bool), np.zeros(n_sets), np.zeros(n_sets), np.full(n_sets, -1.0)

    def _close(self, which: np.ndarray, begin: np.ndarray, end: np.ndarray, n: np.ndarray) -> None:
        """Stretches that end inside the chromosome; one that begins at its first base is no element."""
        which = which & (begin > 0)
        length = end - begin
        short = which & (length <= self.min_len)
        long = which & ~short & (length >= self.max_len)
        kept = which & ~short & ~long
        self.sums["total"] += which
        self.sums["short"] += short
        self.sums["long"] += long
        self.sums["len"] += np.where(kept, length, 0)
        self.sums["n"] += np.where(kept, n, 0)
        self.sums["dens"] += np.where(kept, n / np.maximum(length, 1), 0)
        self.sums["gap"] += np.where(kept & (self.last >= 0), begin - self.last, 0)
        self.last = np.where(kept, end, self.last)

    def add(self, start: int, end: int, parts: np.ndarray) -> None:
        p = dict(zip(PARTS, parts))
        has_head, has_tail = p["head_end"] > start, p["tail_start"] < end
        self._close(self.open & ~has_head, self.begin, np.full_like(self.begin, start), self.n)
        goes_on = self.open & has_head
        begin = np.where(goes_on, self.begin, start)
        n = np.where(goes_on, self.n, 0) + p["head_n"]
        through = has_head & (p["head_end"] == end)
        self._close(has_head & ~through, begin, p["head_end"], n)
        for k in self.sums:
            self.sums[k] += p[k]
        self.sums["gap"] += np.where((p["first"] >= 0) & (self.last >= 0), p["first"] - self.last, 0)
        self.last = np.where(p["last"] >= 0, p["last"], self.last)
        self.open = through | has_tail
        self.begin = np.where(through, begin, p["tail_start"])
        self.n = np.where(through, n, p["tail_n"])

    def finish(self) -> dict[str, np.ndarray]:
        """A stretch open at the end counts as one that opened and is no element otherwise."""
        self.sums["total"] += self.open & (self.begin > 0)
        return self.sums


def hmm_grid_summary(sites: DataFrame, chromes: DataFrame, params: Sequence[HmmParams], min_len: int = 20, max_len: int = 10000,
                     tile_width: int = TILE_WIDTH, block: int = 256) -> DataFrame:
    """``hmm_summary`` for grids of many sets, without a row per stretch.

    Sets go in blocks, as array rows: a tile gives each block its matrices, a fold over the tiles of a chromosome gives what
    enters them, a tile then gives counts and sums of its stretches and those cut by its borders, and a second fold adds
    them up. A group of both folds is a chromosome and a block: its tiles times ``block`` sets. Many sets walk through a tile
    together, ``WALKED_BLOCKS`` blocks at a time (``_Walk``).
    """
    models = _Models(params)
    n_blocks = -(-len(params) // block)
    sets_of = [slice(b * block, min((b + 1) * block, len(params))) for b in range(n_blocks)]
    walked_sets = [slice(b * block, min((b + WALKED_BLOCKS) * block, len(params))) for b in range(0, n_blocks, WALKED_BLOCKS)]
    tiles = cut(hmm_tiles(sites, chromes, False, tile_width))

    def walks() -> list[_Walk]:
        return [_Walk(models, np.arange(w.start, w.stop), min_len, max_len) for w in walked_sets] if len(params) >= MANY_SETS else []

    def parts_of(which: slice, runs: int) -> Iterator[np.ndarray]:
        ids, step = np.arange(which.start, which.stop), max(1, SET_CELLS // max(runs, 1))
        return (ids[i:i + step] for i in range(0, len(ids), step))

    def reduce_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        many = walks()
        for chrom, tile, start, end, reset, lo, hi in _tuples(batches):
            edges, symbol = _tile_runs(start, end, np.asarray(lo), np.asarray(hi), reset)
            length, mats = np.diff(edges), [w.product(edges, symbol, reset) for w in many]
            for ids in () if many else parts_of(slice(0, len(params)), len(length)):
                main, rest, ratio = models.runs(ids, symbol, reset)
                mats.append(_product(main + (ratio**length)[:, :, None, None] * rest))
            mats = np.concatenate(mats)
            yield pd.DataFrame([(chrom, b, tile, mats[which].tobytes()) for b, which in enumerate(sets_of)],
                               columns=["chrom", "block", "tile", "m"])

    def enter_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chrom, b, numbers, mats in _tuples(batches):
            v, rows = None, []
            for tile, m in zip(numbers, mats):
                m = np.frombuffer(m).reshape(-1, 2, 2)
                v = np.full((len(m), 2), 0.5) if v is None else v
                rows.append((chrom, b, tile, v.tobytes()))
                v = np.einsum("sjk,sk->sj", m, v)
                v = v / v.sum(axis=1, keepdims=True)
            yield pd.DataFrame(rows, columns=["chrom", "block", "tile", "v"])

    def walk_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        many = walks()
        for chrom, tile, start, end, reset, lo, hi, group, v in _tuples(batches):
            edges, symbol = _tile_runs(start, end, np.asarray(lo), np.asarray(hi), reset)
            length, v, which = np.diff(edges), np.frombuffer(b"".join(v)).reshape(-1, 2), walked_sets[group]
            parts = [many[group].parts(edges, symbol, reset, v)] if many else []
            for ids in () if many else parts_of(which, len(length)):
                main, rest, ratio = models.runs(ids, symbol, reset)
                entries = _entering(main + (ratio**length)[:, :, None, None] * rest, v[ids - which.start])
                found = _conserved_stretches(main, rest, ratio, edges, symbol, entries)
                parts.append(_tile_parts(len(ids), start, end, found, min_len, max_len))
            parts = np.concatenate(parts, axis=1)
            yield pd.DataFrame(
                [(chrom, group * WALKED_BLOCKS + k, tile, start, end, parts[:, i:i + block].tobytes())
                 for k, i in enumerate(range(0, parts.shape[1], block))], columns=["chrom", "block", "tile", "start", "end", "parts"])

    def fold_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chrom, b, starts, ends, parts in _tuples(batches):
            ids = models.ids[sets_of[b]]
            folded = _Folded(len(ids), min_len, max_len)
            for start, end, raw in zip(starts, ends, parts):
                folded.add(start, end, np.frombuffer(raw).reshape(len(PARTS), -1))
            sums = folded.finish()
            yield pd.DataFrame({"param_id": ids, "chrom": chrom, **{c: sums[k] for c, k in _TOTALS.items()}})

    # few small rows with much work each: dealt to all cores, which sizes of shuffles would not do
    tasks = 4 * tiles.sparkSession.sparkContext.defaultParallelism
    matrices = tiles.select("chrom", "tile", "start", "end", "reset", "lo", "hi").repartition(tasks, "chrom", "tile").mapInPandas(
        _in_frames(reduce_tiles), "chrom string, block int, tile long, m binary")
    lines = matrices.groupBy("chrom", "block").agg(F.sort_array(F.collect_list(F.struct("tile", "m"))).alias("l"))
    entering = lines.select("chrom", "block", "l.tile", "l.m").mapInPandas(enter_tiles, "chrom string, block int, tile long, v binary")
    entering = entering.withColumn("group", F.floor(F.col("block") / WALKED_BLOCKS)).groupBy("chrom", "tile", "group").agg(
        F.sort_array(F.collect_list(F.struct("block", "v"))).alias("l")).select("chrom", "tile", "group", F.col("l.v").alias("v"))
    walked = tiles.join(entering, ["chrom", "tile"]).select("chrom", "tile", "start", "end", "reset", "lo", "hi", "group", "v")
    walked = walked.repartition(tasks, "chrom", "tile", "group")
    partial = walked.mapInPandas(_in_frames(walk_tiles), "chrom string, block int, tile long, start long, end long, parts binary")
    lines = partial.groupBy("chrom", "block").agg(F.sort_array(F.collect_list(F.struct("tile", "start", "end", "parts"))).alias("l"))
    counts = "total_elements", "too_short", "too_long", "_len", "_gap", "sites_in_elements"
    sums = lines.select("chrom", "block", "l.start", "l.end", "l.parts").mapInPandas(
        fold_tiles, "param_id int, chrom string, " + ", ".join(f"{c} double" for c in _TOTALS))
    for c in counts:
        sums = sums.withColumn(c, F.col(c).cast("long"))
    return _report(sums, sites, chromes, params, min_len)


def state_sequence(stretches: DataFrame, sites: DataFrame, chromes: DataFrame, param_ids: Sequence[int],
                   min_len: int = 20, max_len: int = 10000, tile_width: int = TILE_WIDTH) -> DataFrame:
    """One row per base and parameter set: symbol, state, IN/OUT, START/END and, at END, the element just closed.

    Sites, stretches and elements are cut into tiles and brought together there; each tile then writes its bases, so that no row
    of a base is shuffled. Meant for inspection: its size is the genome's.
    """
    def tiled(df: DataFrame, keys: list[str]) -> DataFrame:
        spread = _explode_range(df, F.floor(F.col("start") / tile_width), F.floor((F.col("end") - 1) / tile_width), "tile")
        base = F.col("tile") * tile_width
        piece = F.struct(F.greatest("start", base).alias("s"), F.least("end", base + tile_width).alias("e"), "start")
        return spread.groupBy(*keys, "tile").agg(F.collect_list(piece).alias("p")).select(
            *keys, "tile", F.col("p.s").alias("s"), F.col("p.e").alias("e"), F.col("p.start").alias("begin"))

    symbols = tiled(sites.select("chrom", "start", "end"), ["chrom"]).select("chrom", "tile", F.col("s").alias("ss"), F.col("e").alias("se"))
    inside = tiled(stretches.select("param_id", "chrom", "start", "end"), ["param_id", "chrom"])
    density = F.when(F.col("length_class") == "kept", F.col("density"))
    ended = (hmm_elements(stretches, min_len, max_len).withColumn("tile", F.floor(F.col("end") / tile_width)).groupBy("param_id", "chrom", "tile")
             .agg(F.collect_list(F.struct("start", "end", density.alias("density"))).alias("x"))
             .select("param_id", "chrom", "tile", F.col("x.start").alias("xs"), F.col("x.end").alias("xe"), F.col("x.density").alias("xd")))
    tiles = make_windows(chromes, tile_width).withColumnRenamed("window_no", "tile").withColumn(
        "param_id", F.explode(F.array(*[F.lit(i) for i in param_ids])))
    keys = ["param_id", "chrom", "tile"]
    met = tiles.join(symbols, ["chrom", "tile"], "left").join(inside, keys, "left").join(ended, keys, "left").select(
        "param_id", "chrom", F.col("start").alias("from"), F.col("end").alias("to"), "ss", "se", "s", "e", "begin", "xs", "xe", "xd")

    def bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                lo, n = row["from"], row["to"] - row["from"]
                symbol, state, labels = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int8)
                for s, e in zip(row["ss"] or (), row["se"] or ()):
                    symbol[s - lo:e - lo] = 1
                for s, e, begin in zip(row["s"] or (), row["e"] or (), row["begin"] or ()):
                    state[s - lo:e - lo] = 1
                    if s == begin and s > 0:
                        labels[s - lo] = 1
                at = np.array(row["xe"] or (), np.int64) - lo
                labels[at] = 2
                named = {"elem_start": row["xs"], "elem_end": row["xe"], "elem_density": row["xd"]}
                for k in range(0, n, FRAME_ROWS):
                    part = slice(k, min(k + FRAME_ROWS, n))
                    size, here = part.stop - k, np.flatnonzero((at >= k) & (at < part.stop))
                    pick = np.full(size, -1)
                    pick[at[here] - k] = here
                    where = pa.array(pick, mask=pick < 0)
                    elem = {c: pa.array(v or [], pa.float64() if c == "elem_density" else pa.int64()).take(where) for c, v in named.items()}
                    cols = {"param_id": pa.array(np.full(size, row["param_id"], np.int32)), "chrom": pa.array([row["chrom"]]).take(pa.array(np.zeros(size, np.int64))),
                            "pos": pa.array(np.arange(lo + k, lo + part.stop)), "symbol": pa.array(symbol[part]), "state": pa.array(state[part]),
                            "place": pa.array(["OUT", "IN"]).take(pa.array(state[part])), "change": pa.array(["", "START", "END"]).take(pa.array(labels[part])),
                            **elem, "elem_length": pc.subtract(elem["elem_end"], elem["elem_start"])}
                    yield pa.RecordBatch.from_arrays([cols[c] for c in STATE_COLUMNS], STATE_COLUMNS)

    return met.mapInArrow(bases, "param_id int, chrom string, pos long, symbol int, state int, place string, change string, "
                                 "elem_start long, elem_end long, elem_length long, elem_density double")


STATE_COLUMNS = ["param_id", "chrom", "pos", "symbol", "state", "place", "change", "elem_start", "elem_end", "elem_length", "elem_density"]
