"""Token counts from flat token files: search for separators, stitch documents over blocks by a prefix scan.

A flat file is one long line of ids in fixed blocks; nothing but an end id tells where a document ends.
Every block is searched on its own. A block gives its number of separators, the ids before its first
and behind its last one, and the lengths between. A scan over the blocks of a file carries the open
document from block to block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basetide.llm.common import stored, texts
from basetide.llm.tokens import default_path, narrow, widen, word_encoder

BLOCK_IDS = 1 << 19
#: Blocks of a file that one window of the scan orders; longer files are scanned group by group.
GROUP_BLOCKS = 4096


def write_flat_files(docs: DataFrame, end_id: int = 49407, tokenizer: str | None = None, block_ids: int = BLOCK_IDS,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Flat token files as a stored table (file, block, ids, doc_ids): every partition of ``docs`` is one file,
    cut into blocks of ``block_ids`` ids whatever documents they hold. ``doc_ids`` lists the ids of the
    documents that end in the block; the count never reads that column, it only names documents afterwards.
    """
    tokenizer = tokenizer or default_path("word_bpe_49k.json")
    rows = texts(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file, block = word_encoder(tokenizer), TaskContext.get().partitionId(), 0
        held, n, ended = [], 0, []  # ended: (key, ids up to the document's end)

        def write(line: np.ndarray, keys: list, key_type: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([narrow(line)], pa.binary()),
                 pa.array([keys], pa.list_(key_type))], ["file", "block", "ids", "doc_ids"])

        key_type = None
        for b in batches:
            key_type = b.column("id").type
            for lo in range(0, b.num_rows, 256):
                some = b.slice(lo, 256)
                for key, ids in zip(some.column("id").to_pylist(), enc.encode(some.column("text").to_pylist())):
                    held += [ids, np.array([end_id], np.uint32)]
                    n += len(ids) + 1
                    ended.append((key, n))
                if n < block_ids:
                    continue
                line, at = np.concatenate(held), 0
                while n - at >= block_ids:
                    at += block_ids
                    yield write(line[at - block_ids:at], [k for k, e in ended if at - block_ids < e <= at], key_type)
                    block += 1
                held, n, ended = [line[at:]], n - at, [(k, e - at) for k, e in ended if e > at]
        if n:
            yield write(np.concatenate(held), [k for k, _ in ended], key_type)

    return stored(rows.mapInArrow(run, f"file int, block long, ids binary, doc_ids array<{id_type}>"), "flat-tokens")


def scan_blocks(files: DataFrame, end_id: int = 49407) -> DataFrame:
    """(file, block, n_ids, ends): one row per block from a search for ``end_id``; ``ends`` are the places
    right behind the separators, counted from the block's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = [widen(raw) for raw in b.column("ids").to_pylist()]
            ends = [np.flatnonzero(x == end_id).astype(np.int64) + 1 for x in lines]
            yield pa.RecordBatch.from_arrays(
                [b.column("file"), b.column("block"), pa.array([len(x) for x in lines], pa.int64()),
                 pa.array(ends, pa.list_(pa.int64()))], ["file", "block", "n_ids", "ends"])

    return files.select("file", "block", "ids").mapInArrow(run, "file int, block long, n_ids long, ends array<long>")


def stitch(blocks: DataFrame, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """(file, doc_no, start, n_tokens, closed) of every document of every file; end ids are counted.

    A prefix scan of two levels gives each block the ids and separators before it and the end of the last
    closed document: windows inside groups of blocks, and one over the groups of a file. Ids behind a
    file's last separator are a document of their own with ``closed`` false. A separator that follows
    another directly is a document of one id. Files without ids give no row.
    """
    groups_of = ["file", "_group"]
    inside = Window.partitionBy(*groups_of).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("file").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))

    b = blocks.withColumn("_group", F.floor(F.col("block") / group_blocks)).withColumn("_n_ends", F.size("ends").cast("long"))
    b = b.withColumn("_ids", zero(F.sum("n_ids").over(inside))).withColumn("_docs", zero(F.sum("_n_ends").over(inside)))
    b = b.withColumn("_last", F.col("_ids") + F.try_element_at("ends", F.lit(-1)))  # null without a separator
    groups = b.groupBy(*groups_of).agg(F.sum("n_ids").alias("_gi"), F.sum("_n_ends").alias("_gd"),
                                       F.max("_last").alias("_gl"), F.max("block").alias("_gb"))
    groups = groups.withColumn("_ids0", zero(F.sum("_gi").over(over)))
    groups = groups.select(*groups_of, "_ids0", zero(F.sum("_gd").over(over)).alias("_docs0"),
                           zero(F.max(F.col("_ids0") + F.col("_gl")).over(over)).alias("_last0"),
                           F.max("_gb").over(Window.partitionBy("file")).alias("_final"))
    b = b.withColumn("_open", F.max("_last").over(inside)).join(groups, groups_of)

    begin = F.col("_ids0") + F.col("_ids")
    opened = F.coalesce(F.col("_ids0") + F.col("_open"), F.col("_last0"))
    # the open rest of a file is one more end, behind its last block
    rest = F.when((F.col("block") == F.col("_final")) & (F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)) < F.col("n_ids")),
                  F.array(F.col("n_ids"))).otherwise(F.array().cast("array<long>"))
    flat = b.select("file", begin.alias("_begin"), opened.alias("_opened"), (F.col("_docs0") + F.col("_docs")).alias("_doc"),
                    "_n_ends", "ends", F.posexplode(F.concat("ends", rest)).alias("_i", "_end"))
    start = F.when(F.col("_i") == 0, F.col("_opened")).otherwise(
        F.col("_begin") + F.get("ends", F.col("_i") - 1))
    return flat.select("file", (F.col("_doc") + F.col("_i")).alias("doc_no"), start.alias("start"),
                       (F.col("_begin") + F.col("_end") - start).alias("n_tokens"),
                       (F.col("_i") < F.col("_n_ends")).alias("closed"))


def token_counts(files: DataFrame, end_id: int = 49407) -> DataFrame:
    """Documents and their token counts, found from the separators alone."""
    return stitch(scan_blocks(files, end_id))


def document_names(files: DataFrame) -> DataFrame:
    """(file, doc_no, id): which document is the n-th of its file, from the writer's lists."""
    counts = files.select("file", "block", F.size("doc_ids").cast("long").alias("_n"), "doc_ids")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # block and count only: the lists do not pass the window
    bases = files.select("file", "block", F.size("doc_ids").cast("long").alias("_n")).select(
        "file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (counts.join(bases, ["file", "block"])
            .select("file", "_base", F.posexplode("doc_ids").alias("_i", "id"))
            .select("file", (F.col("_base") + F.col("_i")).alias("doc_no"), "id"))
