"""SimHash near-duplicates by exact comparison of fingerprints that share a piece of their bits.

Equal fingerprints are one row. The bits are cut into ``radius`` + 1 pieces: two fingerprints within ``radius`` bits are equal in
one of them at least, so only fingerprints with an equal piece meet. The other bits of a crowded bucket are cut once more, by the
same rule, and what is crowded then is dealt to tiles that meet pair by pair. Buckets and pairs of tiles are compared
with exclusive-or and bit counts, and pass on a spanning forest of the links they find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.llm.common import cut, texts
from basetide.llm.components import components

#: Fingerprints of a bucket at most, and of a tile by expectation of an even deal.
TILE = 8192


def sequence_hashes(text: str, shingle: int, seed: int = 42) -> np.ndarray:
    """XXH64 values of the ``shingle``-word sequences of the ASCII-lower-cased words, with repeats; a shorter text is one
    sequence, a text without words has none."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(begins[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[s:e], seed) for s, e in spans), np.uint64, n)


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """64-bit fingerprint: ASCII-lower-cased words, ``shingle``-word sequences with repeats (a shorter text is one
    sequence), and a bit for each place set in over half of their XXH64 values; 0 without words."""
    hashes = sequence_hashes(text, shingle, seed)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of some hashes; 0 without any."""
    n, counts = len(hashes), np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 14):
        some = hashes[lo:lo + (1 << 14)].astype("<u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): one row per row of ``docs``; fp is the fingerprint as a signed long. Null texts are empty."""
    rows = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fps.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _forest(a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links ia-ib between two tiles, as many as span their components: every node linked with the smallest."""
    names, at = np.unique(np.concatenate([a[ia], b[ib]]), return_inverse=True)
    x, y = at[:len(ia)], at[len(ia):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if (root == before).all() and (root[x] == root[y]).all():
            break
    child = np.flatnonzero(root != np.arange(len(names)))
    return names[root[child]], names[child]


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all pairs of ``a`` and ``b`` (unsigned 64-bit) that differ in ``radius`` bits at most."""
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for lo in range(0, len(a), block):
        x = a[lo:lo + block]
        y, off = (b[lo:], lo) if same else (b, 0)
        for lo2 in range(0, len(y), 4 * block):
            z = y[lo2:lo2 + 4 * block]
            near = np.bitwise_count(x[:, None] ^ z[None, :]) <= radius
            i, j = np.nonzero(near)
            if same:
                keep = i + lo < j + lo2 + off
                i, j = i[keep], j[keep]
            if len(i):
                u, v = _forest(x, z, i, j)
                left.append(u)
                right.append(v)
    u, v = np.concatenate(left), np.concatenate(right)
    if len(left) > 2:
        u, v = _forest(u, v, np.arange(len(u)), np.arange(len(v)))
    return u, v


def _piece_bounds(bits: int, n: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of ``n`` pieces of a number of ``bits`` bits, as equal as they can be."""
    ends = [bits * i // n for i in range(n + 1)]
    return [(s, e - s) for s, e in zip(ends, ends[1:])]


def _low(value: Column, bits: int) -> Column:
    return value if bits >= 64 else value.bitwiseAND(F.lit((1 << bits) - 1)) if bits else F.lit(0).cast("long")


def _piece(value: Column, first: int, bits: int) -> Column:
    return _low(F.shiftrightunsigned(value, first), bits)


def _without(value: Column, first: int, bits: int, all_bits: int) -> Column:
    """``value`` without some of its bits, those above them moved down."""
    above = F.shiftleft(_piece(value, first + bits, all_bits - first - bits), first) if first + bits < all_bits else F.lit(0).cast("long")
    return above.bitwiseOR(_low(value, first))


def _keyed(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, piece, key): one row a fingerprint and piece; fingerprints that are equal in a piece have its key in common."""
    fp = F.col("fp")
    each = [F.struct(F.lit(i).alias("piece"), F.xxhash64(F.lit(i), _piece(fp, *b)).alias("key"))
            for i, b in enumerate(_piece_bounds(64, radius + 1))]
    return prints.select("fp", F.explode(F.array(*each)).alias("k")).select("fp", "k.piece", "k.key")


def _keyed_again(crowded: DataFrame, radius: int) -> DataFrame:
    """(fp, key): the same for the bits beside the piece that the rows of a bucket have in common."""
    per_piece = []
    for b in _piece_bounds(64, radius + 1):
        rest = _without(F.col("fp"), *b, 64)
        per_piece.append(F.array(*[F.xxhash64("key", F.lit(j), _piece(rest, *c)) for j, c in enumerate(_piece_bounds(64 - b[1], radius + 1))]))
    return crowded.select("fp", F.explode(F.get(F.array(*per_piece), F.col("piece"))).alias("key"))


def _split_off(rows: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the keys with ``tile`` rows at most, and the others with their number of tiles, ``parts``."""
    # as many as rows / tile at most
    hot = F.broadcast(cut(rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts")).where("parts > 1")))
    return rows.join(hot, "key", "left_anti"), rows.join(hot, "key")


def near_links(prints: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(a, b): links between fingerprints of ``prints`` (fp, distinct) that span all components of the relation
    "at most ``radius`` bits differ". Every pair that can be within the radius is compared. ``prints`` is read several times."""
    few, many = _split_off(_keyed(prints, radius), tile)
    few_again, crowded = _split_off(_keyed_again(many, radius), tile)
    fps = F.collect_list("fp").alias("a")
    whole = (few.select("key", "fp").unionByName(few_again.select("key", "fp")).groupBy("key").agg(fps).where(F.size("a") > 1)
             .select("a", F.lit(None).cast("array<long>").alias("b")))
    tiles = cut(crowded.groupBy("key", F.pmod(F.xxhash64("fp"), F.col("parts")).alias("part")).agg(fps))
    second = tiles.select("key", F.col("part").alias("part2"), F.col("a").alias("b"))
    names = tiles.select("key", "part").join(second.select("key", "part2"), "key").where("part <= part2")
    met = names.join(tiles, ["key", "part"]).join(second, ["key", "part2"]).select(
        "key", "part", "part2", "a", F.when(F.col("part") < F.col("part2"), F.col("b")).alias("b"))
    pairs = met.repartition("key", "part", "part2").select("a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[x.values.to_numpy(zero_copy_only=False).view(np.uint64) if x.is_valid else None for x in batch.column(c)]
                     for c in ("a", "b")]
            found = [tile_links(a, a if b is None else b, radius, b is None) for a, b in zip(*sides)]
            u, v = (np.concatenate([np.zeros(0, np.uint64), *x]) for x in zip(*found)) if found else (np.zeros(0, np.uint64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["a", "b"])

    kind = "a long, b long"
    return whole.mapInArrow(compare, kind).unionByName(pairs.mapInArrow(compare, kind))


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42, tile: int = TILE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id): for every row its fingerprint and the smallest id reachable over links.

    Rows with equal fingerprints are linked; texts without words have fingerprint 0 and are linked like
    any other. Rows that repeat an id count each with its own fingerprint. A null id is never a
    ``component_id`` unless all rows of the component have none. Other columns are not read.
    """
    prints = cut(fingerprints(docs, shingle, seed, id_col, text_col))
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("first")))
    links = near_links(distinct.select("fp"), radius, tile)
    roots = components(links)
    grouped = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    known = grouped.join(smallest, "root").select("fp", "component_id")
    return prints.join(known, "fp").select("id", "fp", "component_id")
