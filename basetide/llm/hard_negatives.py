"""Hard negatives by coordinate pruning in length buckets.

Candidates of one label are sorted by length and cut into tiles, tiles into buckets of similar lengths. A bucket keeps
its unit vectors and, for every coordinate, the list of its rows sorted by that coordinate. To reach a score ``t`` with
an anchor of length ``|a|``, a row of the bucket needs a cosine of ``t / (|a| * longest)`` at least, and that bounds
each of its coordinates from both sides. The anchor's strongest coordinates (its focus) cut ranges out of the sorted
lists; rows in the shortest range that also lie in the others are scored exactly. The score asked for rises as
better rows are found, and buckets that cannot reach it are skipped whole.

Two rounds use the same tiles: the best rows of the anchor's own label are its positives, and per positive the best rows
of other labels whose score lies in a band given by the positive's are its negatives. Anchors are a stated query set: their
tiles meet the candidate tiles in blocks, and a task passes on the best rows of each anchor only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basetide.llm.common import stored

#: Rows of a candidate tile, of a bucket in it, and of an anchor tile at most; coordinates looked up per anchor.
TILE, BUCKET, ANCHORS, FOCUS = 8192, 1024, 256, 4
#: Anchor tiles are broadcast up to this many bytes; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: Anchor tiles whose best rows a task keeps before it passes them on.
KEPT_TILES = 64
_SLACK = 1e-9


@dataclass
class Band:
    """Negatives have ``low * positive <= scale * score <= high * positive``."""

    low: int = 30
    high: int = 90
    scale: int = 100

    def limits(self, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest whole score allowed."""
        return -((-self.low * positive) // self.scale), (self.high * positive) // self.scale


def feasible(focus: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of a coordinate of unit vectors that reach ``cosine`` with a unit vector whose coordinate is ``focus``."""
    reach = np.sqrt(np.maximum(0, 1 - focus * focus) * np.maximum(0, 1 - cosine * cosine))
    low = np.where(-focus >= cosine, -1.0, focus * cosine - reach)
    high = np.where(focus >= cosine, 1.0, focus * cosine + reach)
    return low - _SLACK, high + _SLACK


class Bucket:
    """Rows of similar length with sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        x = rows.astype(float)
        length = np.sqrt((x * x).sum(axis=1))
        self.shortest, self.longest = float(length.min()), float(length.max())
        self.unit = x / np.where(length > 0, length, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.lists = np.take_along_axis(self.unit, self.order, axis=0)

    def needed_cosine(self, score: float, length: float) -> float:
        """Cosine that a row needs for ``score`` with an anchor of ``length``; above 1 none has it."""
        by = self.longest if score > 0 else self.shortest
        if length * by == 0:
            return -1.0 if score <= 0 else np.inf
        return score / (length * by)

    def candidates(self, anchor: np.ndarray, length: float, score: float, focus: int = FOCUS) -> np.ndarray:
        """Rows that may reach ``score``: those inside the feasible ranges of the anchor's focus coordinates."""
        cosine = self.needed_cosine(score, length)
        if cosine > 1 + 1e-9:
            return np.zeros(0, np.int64)
        if cosine <= -1 or self.shortest == 0 or length == 0 or not len(anchor):  # a zero vector has no direction
            return np.arange(len(self.ids))
        unit = anchor / length
        f = np.argsort(-np.abs(unit))[:focus]
        low, high = feasible(unit[f], np.full(len(f), min(cosine, 1.0)))
        spans = [(np.searchsorted(self.lists[:, c], lo, "left"), np.searchsorted(self.lists[:, c], hi, "right"))
                 for c, lo, hi in zip(f, low, high)]
        k = int(np.argmin([e - s for s, e in spans]))
        found = self.order[spans[k][0]:spans[k][1], f[k]]
        for j, c in enumerate(f):
            if j != k and len(found):
                v = self.unit[found, c]
                found = found[(v >= low[j]) & (v <= high[j])]
        return found

    def seeds(self, anchor: np.ndarray, n: int) -> np.ndarray:
        """Some rows at the near end of the list of the anchor's strongest coordinate."""
        if not len(anchor):
            return np.arange(min(n, len(self.ids)))
        c = int(np.argmax(np.abs(anchor)))
        return self.order[-n:, c] if anchor[c] > 0 else self.order[:n, c]


def exact(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Whole inner products."""
    return (rows * anchor).sum(axis=1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to smaller ids."""
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


Held = list[tuple[np.ndarray, np.ndarray]]


def search(buckets: list[Bucket], anchor: np.ndarray, own_id: int | None, lows: np.ndarray, highs: np.ndarray, k: int,
           focus: int = FOCUS, held: Held | None = None) -> Held:
    """(scores, ids) of the k best rows for each band of scores lows..highs, those ``held`` from other buckets among
    them; rows named ``own_id`` take no part.

    ``lows`` may be -inf. Scores above a band's end are seen and left out, so that a band never loses rows to them.
    """
    x = anchor.astype(float)
    length = float(np.sqrt((x * x).sum()))
    none = np.zeros(0, np.int64)
    held = list(held) if held else [(none, none) for _ in lows]
    if not len(lows):
        return held

    def floor() -> float:
        """Score below which a row enters no band."""
        return min(max(float(lo), float(s[-1]) if len(s) == k else -np.inf) for lo, (s, _) in zip(lows, held))

    def meet(bucket: Bucket, at: np.ndarray) -> None:
        s, ids = exact(bucket.rows[at], anchor), bucket.ids[at]
        for j, (lo, hi) in enumerate(zip(lows, highs)):
            fit = (s >= lo) & (s <= hi)
            if own_id is not None:
                fit &= ids != own_id
            if fit.any():
                held[j] = best(np.concatenate([held[j][0], s[fit]]), np.concatenate([held[j][1], ids[fit]]), k)

    for bucket in buckets:
        seen = none
        if not all(len(s) == k for s, _ in held):
            seen = bucket.seeds(x, 4 * k)
            meet(bucket, seen)
        found = bucket.candidates(x, length, floor(), focus)
        if len(seen) and len(found):
            found = np.setdiff1d(found, seen, assume_unique=True)
        if len(found):
            meet(bucket, found)
    return held


def tiles(vectors: DataFrame, tile: int = TILE) -> DataFrame:
    """(label, dim, ids, rows): rows of (id, label, v) of one label and dimension and of neighbouring lengths, longest first.

    One range exchange on label and length, so that a label with most rows is many tiles.
    """
    sized = vectors.withColumn("_dim", F.size("v")).withColumn(
        "_len", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    keys = ["label", "_dim", F.desc("_len"), "id"]
    placed = sized.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def pack(label: int, dim: int, ids: list, rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([label], pa.int64()), pa.array([dim], pa.int32()),
             pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
             pa.array([np.concatenate(rows).astype("<i8").tobytes()], pa.binary())], ["label", "dim", "ids", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows, n = None, [], [], 0
        for b in batches:
            labels, dims = b.column("label").to_numpy(), b.column("_dim").to_numpy()
            edges = np.flatnonzero((np.diff(labels) != 0) | (np.diff(dims) != 0)) + 1
            for s, e in zip([0, *edges], [*edges, b.num_rows]):
                if e == s:
                    continue
                own = (int(labels[s]), int(dims[s]))
                if n and own != key:
                    yield pack(*key, ids, rows)
                    ids, rows, n = [], [], 0
                key, at = own, s
                while at < e:
                    step = min(e - at, tile - n)
                    some = b.slice(at, step)
                    ids.append(some.column("id").to_numpy())
                    rows.append(some.column("v").flatten().to_numpy(zero_copy_only=False))
                    n, at = n + step, at + step
                    if n == tile:
                        yield pack(*key, ids, rows)
                        ids, rows, n = [], [], 0
        if n:
            yield pack(*key, ids, rows)

    wanted = placed.select(F.col("label").cast("long").alias("label"), F.col("_dim"), "id", "v")
    return wanted.mapInArrow(run, "label long, dim int, ids binary, rows binary")


def _buckets(ids: np.ndarray, rows: np.ndarray, size: int = BUCKET) -> list[Bucket]:
    """Buckets of neighbouring lengths, longest first; rows without direction stand apart."""
    norms = (rows.astype(float) ** 2).sum(axis=1)
    order = np.argsort(-norms, kind="stable")
    turning = order[norms[order] > 0]
    parts = [turning[k:k + size] for k in range(0, len(turning), size)] + [order[norms[order] == 0]]
    return [Bucket(ids[p], rows[p]) for p in parts if len(p)]


def _meet(anchor_tiles: DataFrame, candidate_tiles: DataFrame, same_label: bool, n_bytes: int) -> DataFrame:
    """Pairs of an anchor tile and a candidate tile of its dimension and of its own or another label."""
    c = candidate_tiles.withColumnsRenamed({"ids": "c_ids", "rows": "c_rows", "label": "c_label", "dim": "c_dim"})
    by = F.col("c_label") == F.col("label") if same_label else F.col("c_label") != F.col("label")
    if n_bytes <= BROADCAST_BYTES:
        return c.join(F.broadcast(anchor_tiles), (F.col("c_dim") == F.col("dim")) & by)
    numbers = anchor_tiles.select("at", "dim", "label")  # two numbers a tile of ANCHORS anchors
    pairs = c.join(numbers, (F.col("c_dim") == F.col("dim")) & by).drop("dim", "label")
    return pairs.join(anchor_tiles, "at")


_ANCHORS = "label long, dim int, ids binary, rows binary, positives binary"


def _anchor_tiles(anchors: DataFrame, tile: int = ANCHORS) -> DataFrame:
    """(at, label, dim, ids, rows, positives): up to ``tile`` anchors (id, label, v, scores) a row; ``positives`` holds the
    positives' scores of each anchor, preceded by their number."""
    keys = ["label", "_dim", "id"]
    placed = anchors.withColumn("_dim", F.size("v")).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, dims = b.column("label").to_numpy(), b.column("_dim").to_numpy()
            edges = np.flatnonzero((np.diff(labels) != 0) | (np.diff(dims) != 0)) + 1
            for s, e in zip([0, *edges], [*edges, b.num_rows]):
                for lo in range(s, e, tile):
                    some = b.slice(lo, min(tile, e - lo))
                    scores = [x for r in some.column("scores").to_pylist() for x in (len(r), *r)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(labels[s])], pa.int64()), pa.array([int(dims[s])], pa.int32()),
                         pa.array([some.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         pa.array([some.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                         pa.array([np.array(scores, "<i8").tobytes()], pa.binary())],
                        ["label", "dim", "ids", "rows", "positives"])

    packed = placed.select(F.col("label").cast("long").alias("label"), "_dim", "id", "v", "scores").mapInArrow(run, _ANCHORS)
    return stored(packed.withColumn("at", F.monotonically_increasing_id()), "anchor-tiles")


def _found(anchors: DataFrame, candidate_tiles: DataFrame, same_label: bool, k: int, band: Band | None, focus: int) -> DataFrame:
    """(anchor_id, positive_rank, id, score): the k best rows of each tile for every anchor (rank 0), or for every positive of
    it within the band."""
    a_tiles = _anchor_tiles(anchors)
    n_bytes = a_tiles.agg(F.sum(F.length("rows")).alias("n")).first()["n"] or 0
    met = _meet(a_tiles, candidate_tiles, same_label, n_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, buckets = None, None
        kept: dict[int, tuple[np.ndarray, list[Held]]] = {}  # anchor tile -> its anchors and their best rows so far

        def passed_on(tile: int) -> pa.RecordBatch:
            cells = [(own, j + (band is not None), s, ids) for own, lists in zip(*kept.pop(tile)) for j, (s, ids) in enumerate(lists)]
            sizes = [len(c[2]) for c in cells]
            flat = lambda k: np.concatenate([c[k] for c in cells]) if cells else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([c[0] for c in cells], sizes).astype(np.int64)), pa.array(np.repeat([c[1] for c in cells], sizes).astype(np.int32)),
                 pa.array(flat(3).astype(np.int64)), pa.array(flat(2).astype(np.int64))], ["anchor_id", "positive_rank", "id", "score"])

        for b in batches:
            for r in range(b.num_rows):
                raw_ids, raw = b.column("c_ids")[r].as_py(), b.column("c_rows")[r].as_py()
                dim, tile = b.column("dim")[r].as_py(), b.column("at")[r].as_py()
                if known != (dim, raw_ids):  # neighbouring pairs often share their candidate tile
                    c_ids = np.frombuffer(raw_ids, "<i8")
                    buckets, known = _buckets(c_ids, np.frombuffer(raw, "<i8").reshape(len(c_ids), dim)), (dim, raw_ids)
                a_ids = np.frombuffer(b.column("ids")[r].as_py(), "<i8")
                a_rows = np.frombuffer(b.column("rows")[r].as_py(), "<i8").reshape(len(a_ids), dim)
                scores, at, lists = np.frombuffer(b.column("positives")[r].as_py(), "<i8"), 0, []
                if tile not in kept and len(kept) >= KEPT_TILES:
                    yield passed_on(next(iter(kept)))
                before = kept[tile][1] if tile in kept else [None] * len(a_ids)
                for own, row, held in zip(a_ids, a_rows, before):
                    n = int(scores[at])
                    mine, at = scores[at + 1:at + 1 + n], at + 1 + n
                    lows, highs = (np.array([-np.inf]), np.array([np.inf])) if band is None else band.limits(mine)
                    lists.append(search(buckets, row, int(own), lows, highs, k, focus, held))
                kept[tile] = (a_ids, lists)
        while kept:
            yield passed_on(next(iter(kept)))

    found = met.mapInArrow(run, "anchor_id long, positive_rank int, id long, score long")
    order = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 10, band: Band | None = None,
                   tile: int = TILE, focus: int = FOCUS) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors`` are (id long, label, v array<long>); rows with a null in one take no part. An anchor's positives
    are the ``n_positives`` rows of its label and not of its id with the highest inner product; for each positive follow the
    ``n_negatives`` best rows of another label whose score lies in the band of the positive's score. Ties go to smaller ids.
    Fewer rows give fewer results, an anchor without positives or negatives none. Of anchors that repeat an id the smallest
    (label, vector) counts; rows that repeat one stand for themselves. Only equal dimensions meet; other columns are not
    read.
    """
    band = band or Band()
    fine = lambda df: df.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "v")
    candidate_tiles = stored(tiles(fine(rows), tile), "candidate-tiles")
    own = fine(anchors).groupBy("id").agg(F.min(F.struct("label", "v")).alias("_a")).select("id", "_a.label", "_a.v")
    own = stored(own, "anchors")
    positives = _found(own.withColumn("scores", F.array().cast("array<long>")), candidate_tiles, True, n_positives, None, focus)
    positives = stored(positives.select("anchor_id", "rank", "id", "score"), "positives")
    lists = positives.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))),
                                                           lambda x: x["score"]).alias("scores"))  # n_positives at most
    asked = own.join(lists, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    negatives = _found(asked, candidate_tiles, False, n_negatives, band, focus)
    named = positives.select(F.col("anchor_id").alias("_a"), F.col("rank").alias("_r"), F.col("id").alias("positive_id"),
                             F.col("score").alias("positive_score"))
    return negatives.join(named, (F.col("anchor_id") == F.col("_a")) & (F.col("positive_rank") == F.col("_r"))).select(
        "anchor_id", "positive_id", "positive_rank", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
