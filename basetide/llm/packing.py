"""Packing by concatenate and cut.

Every document becomes ids plus an end id. All ids form one long line: first the partitions in order,
inside them the documents in order. Two passes give every document its place: totals per partition
and their prefix sum, then a running sum inside each partition. The line is cut into windows of
``seq_len``; a document that crosses window borders becomes one piece per window. Only the last
window can be short, so padding is less than one sequence for the whole corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basetide.llm.common import cut, partition_bases, texts
from basetide.llm.tokens import default_path, narrow, widen, word_encoder

PIECE_COLUMNS = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
PIECE_SCHEMA = ("id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                "ids binary")


#: Of a ``frugal`` run: texts encoded at once, and entries of the word table.
FRUGAL_ROWS, FRUGAL_ENTRIES = 1_000, 200_000


def encode_documents(docs: DataFrame, end_id: int, tokenizer: str, id_col: str = "doc_id",
                     text_col: str = "text", added: bool = False, frugal: bool = False) -> DataFrame:
    """(id, n, ids): one row per document, ids closed by ``end_id``. Null texts count as empty; with ``added`` the string of
    an added token gives its id. ``frugal`` tasks take fewer texts at once and leave no word table behind in their worker, for some
    more time."""
    rows = texts(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(tokenizer, added)
        try:
            for batch in batches:
                step = FRUGAL_ROWS if frugal else max(batch.num_rows, 1)
                for b in (batch.slice(lo, step) for lo in range(0, batch.num_rows, step)):
                    found = enc.encode(b.column("text").to_pylist(), FRUGAL_ENTRIES if frugal else None)
                    ids = [np.append(x, np.uint32(end_id)) for x in found]
                    yield pa.RecordBatch.from_arrays(
                        [b.column("id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([narrow(x) for x in ids], pa.binary())],
                        ["id", "n", "ids"])
        finally:
            if frugal:  # the worker goes on with other tasks
                enc.release()

    return rows.mapInArrow(run, f"id {id_type}, n long, ids binary")


def pack(docs: DataFrame, seq_len: int = 4096, end_id: int = 2, tokenizer: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", added: bool = False, frugal: bool = False) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of all documents.

    ``start`` counts the ids of the document before the piece, ``offset`` the ids of the sequence
    before it; ``ids`` holds the piece (``tokens.widen`` reads it). Null and empty texts are a single
    end id. Rows that repeat an id are packed each on their own, a null id is carried as it is, an empty
    table gives no piece. Other columns are not read. ``added``, ``frugal``: see ``encode_documents``.
    """
    tokenizer = tokenizer or default_path("word_bpe_49k.json")
    ids = cut(encode_documents(docs, end_id, tokenizer, id_col, text_col, added, frugal))  # its partitions and their order are now fixed
    placed = ids.withColumn("_part", F.spark_partition_id())
    bases = partition_bases(placed, "_part", "n", "_base")
    # one row per partition of the checkpoint
    rows = placed.join(F.broadcast(bases), "_part")
    id_type = ids.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0  # ids of this partition so far
        for b in batches:
            rows, out = [], []
            for i, (n, raw, base) in enumerate(zip(*(b.column(c).to_pylist() for c in ("n", "ids", "_base")))):
                line, arr = base + before, widen(raw)
                before += n
                cuts = np.arange(line // seq_len + 1, (line + n - 1) // seq_len + 1) * seq_len - line
                edges = [0, *cuts.tolist(), n]
                for s, e in zip(edges, edges[1:]):
                    part = arr[s:e]
                    rows.append(i)
                    out.append((s, e - s, zlib.crc32(part.tobytes()), n, (line + s) // seq_len, (line + s) % seq_len,
                                narrow(part)))
            numbers = [pa.array([r[k] for r in out], pa.int64()) for k in range(6)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(rows, pa.int64())), *numbers, pa.array([r[6] for r in out], pa.binary())],
                PIECE_COLUMNS)

    return rows.mapInArrow(place, PIECE_SCHEMA.format(id=id_type))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, pieces): the pieces of each sequence in order, at most ``seq_len`` ids a row."""
    order = F.sort_array(F.collect_list(F.struct("offset", "id", "start", "length", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), order.alias("pieces"))
