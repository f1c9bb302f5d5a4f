"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into equal segments at several resolutions; of each segment its mean and deviation are
kept. For vectors q and x, ``sum(len * ((mean_q - mean_x)**2 + (dev_q - dev_x)**2))`` over the segments
is a lower bound of their squared distance, and ``(|q|^2 + |x|^2 - bound) / 2`` therefore an upper bound of
their inner product. Bounds are computed from coarse to fine; what stays above the query's k-th best score
so far gets its exact score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basetide.llm.common import stored

#: Segments at each resolution, coarse to fine.
LEVELS = (1, 4, 16)
CANDIDATE_TILE, QUERY_TILE = 8192, 1024
#: Query tiles are broadcast up to this many bytes; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: Query tiles whose running best a task keeps before it passes them on.
KEPT_TILES = 64


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as longs; null where the vector or a component is null or not finite
    or leaves the whole numbers that a double holds."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < F.lit(float(1 << 53)), F.lit(False))
                    & ~F.isnan(c))
    return F.when(vector.isNotNull() & fine, x)


def statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, weighted so that a plain inner product of two rows of the
    result bounds that of the vectors. Uneven dimensions give segments of two lengths."""
    edges = np.linspace(0, rows.shape[1], min(segments, rows.shape[1]) + 1).astype(int)
    out = []
    for s, e in zip(edges, edges[1:]):
        part = rows[:, s:e]
        root = np.sqrt(e - s)
        out += [part.mean(axis=1) * root, part.std(axis=1) * root]
    return np.stack(out, axis=1) if out else np.zeros((len(rows), 1))


class Best:
    """The k best (score, id) of each query so far; ties go to smaller ids."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.scores = np.zeros((len(query_ids), 0), np.int64)
        self.ids = np.zeros((len(query_ids), 0), np.int64)
        self.filled = np.zeros((len(query_ids), 0), bool)

    def floor(self) -> np.ndarray:
        """Score below which a candidate cannot enter."""
        if self.scores.shape[1] < self.k:
            return np.full(len(self.query_ids), -np.inf)
        return np.where(self.filled[:, -1], self.scores[:, -1].astype(float), -np.inf)

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge candidates given as flat (query row, score, id)."""
        keep = self.filled.nonzero()
        q = np.concatenate([keep[0], q])
        scores, ids = np.concatenate([self.scores[keep], scores]), np.concatenate([self.ids[keep], ids])
        order = np.lexsort((ids, -scores, q))
        q, scores, ids = q[order], scores[order], ids[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top = rank < self.k
        shape = (len(self.query_ids), self.k)
        self.scores, self.ids, self.filled = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, bool)
        at = (q[top], rank[top])
        self.scores[at], self.ids[at], self.filled[at] = scores[top], ids[top], True


def search_tile(best: Best, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, levels: Sequence[int] = LEVELS) -> None:
    """Meet all queries of a tile with all candidates of a tile."""
    q, x = queries.astype(float), rows.astype(float)
    exact_floats = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])) < 2.0 ** 52
    other = best.query_ids[:, None] != ids[None, :]

    def score(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for lo in range(0, len(i), 1 << 16):
            a, b = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
            out[lo:lo + len(a)] = (np.einsum("ij,ij->i", q[a], x[b]).astype(np.int64) if exact_floats
                                   else (queries[a] * rows[b]).sum(axis=1))
        return out

    q_norm, x_norm = (q * q).sum(axis=1), (x * x).sum(axis=1)
    slack = 1e-9 * (q_norm[:, None] + x_norm[None, :]) + 1e-6
    live = other
    for n, segments in enumerate(levels):
        a, b = statistics(q, segments), statistics(x, segments)
        lower = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
        upper = (q_norm[:, None] + x_norm[None, :] - np.maximum(lower, 0)) / 2 + slack
        if n == 0:  # exact scores of the most promising give a first floor
            k = min(best.k, upper.shape[1])
            seeds = np.argpartition(np.where(live, -upper, np.inf), k - 1, axis=1)[:, :k]
            i, j = np.repeat(np.arange(len(q)), k), seeds.ravel()
            own = live[i, j]
            i, j = i[own], j[own]
            best.add(i, score(i, j), ids[j])
            live = live.copy()
            live[i, j] = False  # they have been met
        live = live & (upper >= best.floor()[:, None])
    i, j = live.nonzero()
    if len(i) > 0.05 * live.size and exact_floats:
        s = (q @ x.T)[i, j].astype(np.int64)
    else:
        s = score(i, j)
    fit = s >= best.floor()[i]
    best.add(i[fit], s[fit], ids[j[fit]])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py():column.offsets[-1].as_py()].reshape(-1, dim)


def pack_tiles(vectors: DataFrame, tile: int) -> DataFrame:
    """(dim, ids, rows): up to ``tile`` vectors of (id, v) a row, as little-endian longs, without a shuffle.
    Vectors of different dimensions go to different tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.diff(b.column("v").offsets.to_numpy())
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), tile):
                    some = b.take(pa.array(at[lo:lo + tile]))
                    rows = some.column("v").flatten().to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(dim)], pa.int32()), pa.array([some.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         pa.array([rows.astype("<i8").tobytes()], pa.binary())], ["dim", "ids", "rows"])

    return vectors.mapInArrow(run, "dim int, ids binary, rows binary")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, levels: Sequence[int] = LEVELS,
          candidate_tile: int = CANDIDATE_TILE, query_tile: int = QUERY_TILE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` candidates with the highest inner product.

    Both sides are (id long, v array<long>); rows with a null in either take no part. Ties go to the
    smaller id, candidates with the query's own id are left out, and only equal dimensions meet. Of
    queries that repeat an id the smallest vector counts; candidates that repeat one stand for
    themselves. Fewer candidates than ``k`` give fewer rows; empty sides give none.
    """
    fine = lambda df: df.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    own = fine(queries).groupBy("id").agg(F.min("v").alias("v"))
    q_tiles = stored(pack_tiles(own, query_tile).withColumn("qt", F.monotonically_increasing_id()), "query-tiles")
    size = q_tiles.agg(F.sum(F.length("rows")).alias("n")).first()["n"] or 0
    numbers = q_tiles.select("qt", "dim")
    c_tiles = pack_tiles(fine(candidates), candidate_tile)
    if size <= BROADCAST_BYTES:
        met = c_tiles.withColumnsRenamed({"ids": "c_ids", "rows": "c_rows"}).join(F.broadcast(q_tiles), "dim")
    else:
        # candidate tiles go to where blocks of query tiles are
        met = (c_tiles.withColumnsRenamed({"ids": "c_ids", "rows": "c_rows"})
               .join(F.broadcast(numbers), "dim").join(q_tiles.drop("dim"), "qt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, Best] = {}

        def flush(which) -> pa.RecordBatch:
            parts = [kept.pop(t) for t in which]
            cells = [p.filled.nonzero() for p in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([p.query_ids[c[0]] for p, c in zip(parts, cells)])),
                 pa.array(np.concatenate([p.ids[c] for p, c in zip(parts, cells)])),
                 pa.array(np.concatenate([p.scores[c] for p, c in zip(parts, cells)]))], ["query_id", "vec_id", "score"])

        for b in batches:
            for r in range(b.num_rows):
                qt, dim = b.column("qt")[r].as_py(), b.column("dim")[r].as_py()
                q_ids, q_rows, c_ids, c_rows = (np.frombuffer(b.column(c)[r].as_py(), "<i8")
                                                for c in ("ids", "rows", "c_ids", "c_rows"))
                if qt not in kept:
                    if len(kept) >= KEPT_TILES:
                        yield flush([next(iter(kept))])
                    kept[qt] = Best(q_ids, k)
                shape = (-1, dim) if dim else (len(c_ids), 0)
                for lo in range(0, len(q_ids), 256):  # bounds the size of the bound matrices
                    part = kept[qt]
                    sub = Best(q_ids[lo:lo + 256], k)
                    if part.scores.shape[1]:
                        sub.scores, sub.ids, sub.filled = (x[lo:lo + 256] for x in (part.scores, part.ids, part.filled))
                    search_tile(sub, q_rows.reshape(shape if dim else (len(q_ids), 0))[lo:lo + 256], c_ids,
                                c_rows.reshape(shape), levels)
                    if not part.scores.shape[1]:
                        full = (len(q_ids), k)
                        part.scores, part.ids, part.filled = np.zeros(full, np.int64), np.zeros(full, np.int64), np.zeros(full, bool)
                    part.scores[lo:lo + 256], part.ids[lo:lo + 256], part.filled[lo:lo + 256] = sub.scores, sub.ids, sub.filled
        if kept:
            yield flush(list(kept))

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
