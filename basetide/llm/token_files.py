"""Token files as tables of 64-bit words: Simple-8b coding with escapes and per-block offsets.

A 64-bit word holds a 4-bit selector and 60 bits of ids of one width; selector 0 marks an escape, and
the next word is the id itself. Ids are cut into blocks of ``BLOCK`` ids, every block starts on a
word, and a segment keeps where each block starts, so that blocks are decoded independently and any
id is found without reading what stands before it. A segment is one row of a Parquet table in shared
storage: header columns, block offsets, words and the number of ids of each document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basetide.llm.common import cut, partition_bases, stored, texts
from basetide.llm.tokens import default_path, word_encoder

BLOCK = 1024
#: Ids after which a segment is closed at the next document end.
SEGMENT_IDS = 1 << 20
#: Starts of segments are broadcast up to this many.
BROADCAST_SEGMENTS = 1_000_000

#: Fixed values of the coding: selector -> (ids in a word, bits of an id). Selector 0 is the escape.
SELECTORS = {
    1: (120, 0), 2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6), 8: (8, 7),
    9: (7, 8), 10: (6, 10), 11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60),
}


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit lengths of unsigned 64-bit ids."""
    if int(ids.max()) < 1 << 53:  # exact as floating-point numbers, whose exponents are the lengths
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    out = np.zeros(len(ids), np.uint8)
    rest = ids.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1) << np.uint64(step)
        out[big] += step
        rest[big] >>= np.uint64(step)
    return out + (rest > 0)


def _fitting(bits: np.ndarray) -> np.ndarray:
    """The selector with most ids that fit from each column on, zeros behind a row's end; 0 where none does. The largest value of
    the next n columns comes from that of fewer columns, so every width takes one step."""
    chosen = np.zeros(bits.shape, np.uint8)
    least, widest, have = bits.min(), bits, 1
    for sel in sorted(SELECTORS, reverse=True):  # more and more ids
        n, width = SELECTORS[sel]
        if width < least:  # no narrower one fits anywhere either
            break
        while have < n:
            step = min(have, n - have)
            ahead = widest.copy()
            np.maximum(widest[:, :-step], widest[:, step:], out=ahead[:, :-step])
            widest, have = ahead, have + step
        np.copyto(chosen, np.uint8(sel), where=widest <= width)
    return chosen


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets): unsigned 64-bit words and the first word of each block. Each word takes the selector with most ids that
    fit; the first ids of words are found for all blocks together, one word a step, and the words of a selector are filled at once."""
    total = len(ids)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    n_blocks, most = -(-total // block), max(n for n, _ in SELECTORS.values())
    # zeros behind every block, so that its last word may reach over the end
    grid = np.zeros((n_blocks, block + most), np.uint64)
    whole = total // block
    grid[:whole, :block] = ids[:whole * block].reshape(whole, block)
    grid[whole:, :total - whole * block] = ids[whole * block:]
    chosen = _fitting(_bits(grid[:, :block].ravel()).reshape(n_blocks, block)).ravel()
    grid = grid.ravel()
    size = np.array([1] + [SELECTORS[s][0] for s in range(1, 16)])
    at = np.arange(n_blocks) * block
    stop = np.minimum(at + block, total)
    is_first = np.zeros(n_blocks * block, bool)
    live = np.arange(n_blocks)
    while len(live):
        here = at[live]
        is_first[here] = True
        at[live] = here = here + size[chosen[here]]
        live = live[here < stop[live]]
    start = np.flatnonzero(is_first)
    owner, sel = start // block, chosen[start]
    place = start + owner * most
    word = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel):
        if s == 0 or not SELECTORS[int(s)][1]:
            continue
        n, width = SELECTORS[int(s)]
        rows = np.flatnonzero(sel == s)
        first, filled = place[rows], word[rows]
        for j in range(n):
            filled |= grid[first + j] << np.uint64(j * width)
        word[rows] = filled
    # a raw id follows its escape
    words = 1 + (sel == 0)
    behind = np.cumsum(words) - 1
    out = np.empty(int(behind[-1]) + 1, np.uint64)
    out[behind] = np.where(sel == 0, grid[place], word)
    escape = np.flatnonzero(sel == 0)
    out[behind[escape] - 1] = word[escape]
    counts = np.bincount(owner, weights=words, minlength=n_blocks).astype(np.int64)
    return out, (np.cumsum(counts) - counts).astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, total: int, block: int = BLOCK) -> np.ndarray:
    """All ids of a segment; any run of blocks is decoded by passing its words, its offsets less the
    first one, and its number of ids."""
    out = np.zeros(total, np.uint64)
    if not total:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = _escaped(sel)
    size = np.array([1] + [SELECTORS[s][0] for s in range(1, 16)])[sel]
    size[raw] = 0
    n_blocks = len(offsets)
    block_of = np.repeat(np.arange(n_blocks), np.diff(np.append(offsets.astype(np.int64), len(words))))
    run = np.cumsum(size) - size
    first = run - run[offsets.astype(np.int64)][block_of]  # ids of the block before the word
    length = np.full(n_blocks, block)
    length[-1] = total - (n_blocks - 1) * block
    keep = np.minimum(size, length[block_of] - first)
    first += block_of * block
    at = np.flatnonzero(raw)
    out[first[at - 1]] = words[at]
    sel[raw] = 0
    for s, (n, width) in SELECTORS.items():
        rows = np.flatnonzero(sel == s)
        if not width or not len(rows):
            continue
        mask = np.uint64((1 << width) - 1)
        for j in range(n):
            some = rows[keep[rows] > j]
            out[first[some] + j] = (words[some] >> np.uint64(j * width)) & mask
    return out


def _escaped(sel: np.ndarray) -> np.ndarray:
    """Which words are raw ids: those behind an escape that is not raw itself (a raw word may look like one)."""
    raw = np.zeros(len(sel), bool)
    last = -1
    for i in np.flatnonzero(sel == 0):
        if i != last:
            last = i + 1
            raw[last] = True
    return raw


SEGMENT_SCHEMA = ("part int, segment int, n_ids long, n_docs long, ids array<{id}>, doc_ids binary, offsets binary, words binary")


def write_token_files(docs: DataFrame, end_id: int = 1, tokenizer: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text", segment_ids: int = SEGMENT_IDS, added: bool = False) -> DataFrame:
    """Encode all documents in ascending id order and write them as segments; returns the written table.

    Ranges of ids go to one partition each, so the table's order is (part, segment). Rows with the same id
    follow each other in the order of their texts; a null id comes first; null and empty texts are a
    single end id. Other columns are not read. An empty table gives no segment. With ``added`` the string of an
    added token gives its id, else it is ordinary text.
    """
    tokenizer = tokenizer or default_path("word_bpe_49k.json")
    rows = texts(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    # only ids and texts are sampled for the ranges; encoding comes after the exchange
    ordered = (rows.withColumn("_t", F.xxhash64("text")).repartitionByRange("id", "_t")
               .sortWithinPartitions("id", "_t", "text").drop("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, segment = word_encoder(tokenizer, added), TaskContext.get().partitionId(), 0
        keys, held, n = [], [], 0

        def close():
            line = np.concatenate(held).astype(np.uint64)
            words, offsets = encode(line)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(line)], pa.int64()),
                 pa.array([len(held)], pa.int64()), pa.array([keys], pa.list_(key_type)),
                 pa.array([np.array([len(x) for x in held], "<u8").tobytes()], pa.binary()),
                 pa.array([offsets.astype("<u4").tobytes()], pa.binary()),
                 pa.array([words.astype("<u8").tobytes()], pa.binary())],
                ["part", "segment", "n_ids", "n_docs", "ids", "doc_ids", "offsets", "words"])

        for b in batches:
            key_type = b.column("id").type
            for lo in range(0, b.num_rows, 256):
                some = b.slice(lo, 256)
                for key, ids in zip(some.column("id").to_pylist(), enc.encode(some.column("text").to_pylist())):
                    keys.append(key)
                    held.append(np.append(ids, np.uint32(end_id)))
                    n += len(held[-1])
                    if n >= segment_ids:
                        yield close()
                        keys, held, n, segment = [], [], 0, segment + 1
        if held:
            yield close()

    return stored(ordered.mapInArrow(run, SEGMENT_SCHEMA.format(id=id_type)), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document, decoded from the segments. ``start`` is the
    number of ids before the document over all segments in (part, segment) order."""
    id_type = files.schema["ids"].dataType.elementType.simpleString()
    # starts by two prefix sums, over the segments of a part and over the parts; only numbers are exchanged for them
    numbers = files.select("part", "segment", "n_ids")
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbers.withColumn("_in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(
        partition_bases(numbers, "part", "n_ids", "_base"), "part").select(
        F.col("part").alias("_p"), F.col("segment").alias("_s"), (F.col("_base") + F.col("_in")).alias("_start"))
    starts = cut(starts)
    few = starts.count() <= BROADCAST_SEGMENTS  # three numbers a segment of a million ids; beyond, the words are shuffled once
    placed = files.join(F.broadcast(starts) if few else starts, (F.col("part") == F.col("_p")) & (F.col("segment") == F.col("_s")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                line = decode(np.frombuffer(r["words"], "<u8"), np.frombuffer(r["offsets"], "<u4"), r["n_ids"])
                n = np.frombuffer(r["doc_ids"], "<u8").astype(np.int64)
                ends = np.cumsum(n)
                ids = [line[e - k:e].astype("<u4").tobytes() for e, k in zip(ends, n)]
                keys = pa.array(r["ids"], b.column("ids").type.value_type)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(r["_start"] + ends - n), pa.array(n), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["id", "start", "n_tokens", "ids_crc32", "ids"])

    wanted = placed.select("ids", "doc_ids", "offsets", "words", "n_ids", "_start")
    return wanted.mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids_crc32 long, ids binary")
