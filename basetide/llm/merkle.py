"""Merkle manifest of a table as postorder append logs, with inclusion proofs.

Leaves of a group are numbered in order and cut into aligned blocks of ``arity ** LEVELS``. The builder of a block
appends every node to the block's log as soon as its children are complete, so the log is the postorder of the
block's tree. Where a node stands follows from subtree sizes alone (``position``), which is how the siblings of a
proof are found: no pointers are stored and no node is searched. The roots of the blocks are the leaves of the next
pass, until one block holds a group; the groups' roots are built into one tree the same way. Proofs go down the same
passes: every block gets the siblings above its root and hands them on, lengthened, to its leaves.

Blocks have one size however rows are spread over groups, so that a group with most rows is many blocks. Every pass is
a table in shared storage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from basetide.llm.common import stored

#: Levels of a block: its builder meets arity ** LEVELS leaves at most (4,096 of 8 children).
LEVELS = 4
_ROW = (1 << 33) - 1  # the bits of monotonically_increasing_id that number the rows of a partition


def digest(parts: bytes) -> bytes:
    """Lowercase hex SHA-256, as ASCII bytes."""
    return hashlib.sha256(parts).hexdigest().encode()


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 as binary of the columns in order: ``-`` for a null, else the value's UTF-8 length, ``:`` and the value."""
    text = [c.cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                                     for t in text)), 256))


def sizes(n: int, height: int, arity: int = 8) -> list[int]:
    """Nodes at each level, leaves first."""
    return [-(-n // arity ** h) for h in range(height + 1)]


def tree_height(n: int, arity: int = 8) -> int:
    """Levels above the leaves until one node remains."""
    h = 0
    while arity ** h < n:
        h += 1
    return h


def position(level, index, n: int, height: int, arity: int = 8) -> np.ndarray:
    """Place in the postorder log of the nodes (level, index) of a tree of ``n`` leaves and ``height`` levels above them.

    Before a node stand all nodes that end at an earlier leaf, and the lower ones that end at its own. Level h has
    ``end // arity ** h`` nodes that are full and end by ``end``; nodes of the right edge that stay short come last.
    """
    level, index = np.asarray(level, np.int64), np.asarray(index, np.int64)
    powers = arity ** np.arange(height + 1, dtype=np.int64)
    end = np.minimum((index + 1) * powers[level], n)
    full = (end[..., None] // powers).sum(axis=-1)
    ends_here = end[..., None] % powers == 0
    levels = np.arange(height + 1)
    not_yet = (ends_here & (levels >= level[..., None])).sum(axis=-1)
    short_before = (~ends_here & (levels < level[..., None])).sum(axis=-1)
    return np.where(end % powers[level] == 0, full - not_yet, full + short_before)


def postorder(leaves: list[bytes], height: int, arity: int = 8) -> list[bytes]:
    """Nodes of a tree in the order they are completed. Open runs of each level are all that is held besides the log."""
    log, open_runs = [], [[] for _ in range(height + 1)]

    def append(level: int, node: bytes) -> None:
        log.append(node)
        if level < height:
            open_runs[level].append(node)
            if len(open_runs[level]) == arity:
                close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        append(level + 1, digest(b"".join(run)))

    for leaf in leaves:
        append(0, leaf)
    for level in range(height):  # short runs at the right edge
        if open_runs[level]:
            close(level)
    return log


def places(n: int, height: int, arity: int = 8) -> list[list[int]]:
    """Places in the log of all nodes of each level."""
    return [position(np.full(c, h), np.arange(c), n, height, arity).tolist() for h, c in enumerate(sizes(n, height, arity))]


def siblings(log: list[bytes], where: list[list[int]], leaf: int, arity: int = 8) -> list[tuple[int, list[bytes]]]:
    """(place in the run, the run's other nodes) of a leaf's path, level by level; ``where`` has the places in ``log``."""
    out, at = [], leaf
    for level in where[:-1]:
        first = at // arity * arity
        out.append((at - first, [log[p] for k, p in enumerate(level[first:first + arity], first) if k != at]))
        at //= arity
    return out


def fold(leaf: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """Root that a leaf and the siblings of its path give."""
    for place, others in path:
        leaf = digest(b"".join([*others[:place], leaf, *others[place:]]))
    return leaf


def proof_digest(path: list[tuple[int, list[bytes]]]) -> bytes:
    return digest(b"".join(x for _, others in path for x in others))


def _raw(nodes: list[bytes]) -> bytes:
    return bytes.fromhex(b"".join(nodes).decode())


def _hex(raw: bytes) -> list[bytes]:
    line = raw.hex().encode()
    return [line[k:k + 64] for k in range(0, len(line), 64)]


def _write_path(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes([place, len(others)]) + _raw(others) for place, others in path)


def _read_path(raw: bytes) -> list[tuple[int, list[bytes]]]:
    out, at = [], 0
    while at < len(raw):
        place, n = raw[at], raw[at + 1]
        out.append((place, _hex(raw[at + 2:at + 2 + 32 * n])))
        at += 2 + 32 * n
    return out


@dataclass
class Manifest:
    """Log tables, leaves' blocks first: ``within`` the groups and over the groups' roots (``top``).

    A row is a block: ``_group`` (within only), ``builder`` (its number), ``n`` (leaves of its tree in this pass), ``m`` (its
    own), ``height``, ``nodes`` (32-byte digests in postorder), ``top`` (its root); the first pass within groups also has
    ``_id`` and the carried columns of its leaves, the first one over the roots ``_key``, the groups.
    """

    within: list[DataFrame]
    top: list[DataFrame]
    arity: int
    levels: int


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``_idx``, the place in its group by ``order`` (nulls first), and ``_n``, the group's rows.

    One range exchange; places come from totals per partition and group, so no group passes one task.
    """
    placed = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    placed = stored(placed.withColumn("_part", F.spark_partition_id())
                    .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW))), "merkle-order")
    totals = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_row").alias("_first"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*(F.col(g).alias(f"_g{k}") for k, g in enumerate(group)), F.col("_part").alias("_p"), "_first",
                           F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"), F.sum("_c").over(whole).alias("_n"))
    same = F.col("_part") == F.col("_p")
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    return (placed.join(totals, same).withColumn("_idx", F.col("_base") + F.col("_row") - F.col("_first"))
            .drop("_part", "_row", "_p", "_first", "_base", *(f"_g{k}" for k in range(len(group)))))


def _schema(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def _blocks(nodes: DataFrame, group: list[str], carried: list[str], arity: int, levels: int) -> DataFrame:
    """The log of every block of ``nodes`` (*group, _idx, _n, digest, *carried)."""
    size = arity ** levels
    row = F.struct("_idx", "digest", *carried)
    grouped = (nodes.withColumn("builder", F.floor(F.col("_idx") / size)).groupBy(*group, "builder")
               .agg(F.first("_n").alias("n"), F.sort_array(F.collect_list(row)).alias("rows")))
    grouped = grouped.select(*group, "builder", "n", F.col("rows.digest").alias("digests"),
                             *(F.col(f"rows.{c}").alias(c) for c in carried))
    kept = [*group, "builder", "n", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                some = b.slice(k, 1)
                leaves = [x.hex().encode() for x in some.column("digests")[0].as_py()]
                height = tree_height(len(leaves), arity) if some.column("n")[0].as_py() <= size else levels
                log = postorder(leaves, height, arity)
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in kept), pa.array([len(leaves)], pa.int32()), pa.array([height], pa.int32()),
                     pa.array([_raw(log)], pa.binary()), pa.array([_raw(log[-1:])], pa.binary())],
                    [*kept, "m", "height", "nodes", "top"])

    return grouped.mapInArrow(run, _schema(grouped, kept) + ", m int, height int, nodes binary, top binary")


def _passes(nodes: DataFrame, group: list[str], carried: list[str], arity: int, levels: int) -> list[DataFrame]:
    """Passes until every tree is one block; a tree that is takes no part in further ones."""
    passes, size = [], arity ** levels
    while True:
        passes.append(stored(_blocks(nodes, group, carried, arity, levels), "merkle-log"))
        more = passes[-1].where(F.col("n") > size)
        if more.isEmpty():
            return passes
        nodes, carried = more.select(*group, F.col("builder").alias("_idx"), F.ceil(F.col("n") / size).alias("_n"),
                                     F.col("top").alias("digest")), []


def build(leaves: DataFrame, group: str, id_col: str, carried: list[str], arity: int = 8, levels: int = LEVELS) -> Manifest:
    """The manifest of ``leaves`` (group, id, digest binary, *carried).

    Leaves of a group stand by id, nulls first, then by digest; groups stand by value, null first, strings in byte order.
    Equal rows are leaves of their own. An empty table has logs without rows. A tree of one leaf is that leaf.
    """
    rows = leaves.select(F.col(group).alias("_group"), F.col(id_col).alias("_id"), "digest", *carried)
    rows = stored(rows.withColumn("_u", F.monotonically_increasing_id()), "merkle-leaves")  # _u deals out equal rows
    nodes = numbered(rows, ["_group"], ["_id", "digest", "_u"])
    within = _passes(nodes, ["_group"], ["_id", *carried], arity, levels)
    done = [p.where(F.col("n") <= arity ** levels).select(F.col("_group").alias("_key"), F.col("top").alias("digest"))
            for p in within]
    roots = done[0]
    for other in done[1:]:
        roots = roots.unionByName(other)
    return Manifest(within, _passes(numbered(roots, [], ["_key"]), [], ["_key"], arity, levels), arity, levels)


def _descend(logs: DataFrame, above: DataFrame, group: list[str], arity: int, schema: StructType, emit) -> DataFrame:
    """A row of ``emit(block, k, leaf, path)`` for the k-th leaf of every block of ``logs``. ``above`` (*group, builder, above,
    root, ...) has, for every block, the path over its root and what goes down with it; a block is a dict of both."""
    keys = F.col("builder") == F.col("_b")
    for k, g in enumerate(group):
        keys = keys & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    up = above.withColumnsRenamed({"builder": "_b", **{g: f"_g{k}" for k, g in enumerate(group)}})
    met = logs.drop("top").join(up, keys).drop("_b", *(f"_g{k}" for k in range(len(group))))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                block = {c: b.column(c)[k].as_py() for c in b.schema.names}
                log, where = _hex(block["nodes"]), places(block["m"], block["height"], arity)
                rows = [emit(block, j, log[p], siblings(log, where, j, arity)) for j, p in enumerate(where[0])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return met.mapInArrow(run, schema)


def _pass_down(passes: list[DataFrame], above: DataFrame, group: list[str], down: list[str], arity: int, levels: int) -> DataFrame:
    """``above`` for the blocks of the first pass, from those of all trees' last blocks (builder 0)."""
    size = arity ** levels
    names = [*group, "builder", "above", *down]
    schema = StructType([passes[0].schema[g] for g in group] + [StructField("builder", LongType()), StructField("above", BinaryType())]
                        + [above.schema[c] for c in down])

    def emit(block, j, leaf, path):
        return (*(block[g] for g in group), block["builder"] * size + j, _write_path(path) + block["above"], *(block[c] for c in down))

    got = None
    for k in range(len(passes) - 1, -1, -1):
        logs = passes[k]
        last = logs.where(F.col("n") <= size).select(*(F.col(g).alias(f"_l{i}") for i, g in enumerate(group)))
        if group:
            on = None
            for i, g in enumerate(group):
                same = F.col(g).eqNullSafe(F.col(f"_l{i}"))
                on = same if on is None else on & same
            begin = above.select(*names).join(last, on, "left_semi")
        else:
            begin = above.select(*names) if k == len(passes) - 1 else above.select(*names).where(F.lit(False))
        here = begin if got is None else begin.unionByName(got)
        if k == 0:
            return here
        got = stored(_descend(logs, here, group, arity, schema, emit), "merkle-paths")


def prove(manifest: Manifest, changed: str | None = None) -> DataFrame:
    """(id, group, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf, digests as lowercase hex.

    ``proof_sha256`` is the digest of all siblings on the way from the leaf over its group's root to the root;
    ``folded_root`` comes from these siblings and the digest in the carried column ``changed`` where it is not null, else the
    leaf itself; ``verified`` tells whether it is the root.
    """
    arity, levels = manifest.arity, manifest.levels
    tops = manifest.top
    start = tops[-1].select(F.lit(0).cast("long").alias("builder"), F.lit(b"").alias("above"), F.col("top").alias("root"))
    over = _pass_down(tops, start, [], ["root"], arity, levels)
    key = tops[0].schema["_key"].dataType.elementType

    def to_group(block, j, leaf, path):
        return block["_key"][j], 0, _write_path(path) + block["above"], block["root"], bytes.fromhex(leaf.decode())

    group_schema = StructType([StructField("_group", key), StructField("builder", LongType()), StructField("above", BinaryType()),
                               StructField("root", BinaryType()), StructField("subroot", BinaryType())])
    groups = stored(_descend(tops[0], over, [], arity, group_schema, to_group), "merkle-paths")
    below = _pass_down(manifest.within, groups, ["_group"], ["root", "subroot"], arity, levels)
    first = manifest.within[0]
    out = StructType([StructField("id", first.schema["_id"].dataType.elementType), StructField("group", first.schema["_group"].dataType),
                      *(StructField(c, StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
                      StructField("verified", BooleanType())])

    def to_row(block, j, leaf, path):
        path = path + _read_path(block["above"])
        other = block[changed][j] if changed else None
        root, folded = block["root"].hex(), fold(leaf if other is None else other.hex().encode(), path).decode()
        return (block["_id"][j], block["_group"], leaf.decode(), block["subroot"].hex(), root, proof_digest(path).decode(), folded,
                folded == root)

    return _descend(first, below, ["_group"], arity, out, to_row)


def document_leaves(docs: DataFrame, tampered: Column | None = None, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, group, digest, changed): the leaf of every row over ``columns``, and, where ``tampered`` holds, that of the row
    with the text's A-Z lower-cased. Nulls, empty texts and repeated rows are leaves like others; further columns are not read."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    own = [F.col(c) for c in columns]
    other = [F.translate(c, upper, upper.lower()) if n == text_col else c for n, c in zip(columns, own)]
    changed = F.when(tampered, leaf_digest(*other)) if tampered is not None else F.lit(None).cast("binary")
    return docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("group"), leaf_digest(*own).alias("digest"),
                       changed.alias("changed"))
