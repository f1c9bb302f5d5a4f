"""Byte-level BPE by overlapping chunks.

A long text is cut into chunks that overlap; every chunk is pre-tokenised on its own, in parallel. A
match of the pattern depends only on the text from its start on, so two chunks agree from the first
boundary they share. Tokens of a chunk count from the boundary it shares with the chunk before it to
the one it shares with the chunk behind it. Decoding concatenates the raw bytes of the ids.

Every overlap reaches past a change from other characters to white space and back to others. All matches
end at such a change wherever they started, so the chunks on both sides have a boundary there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basetide.llm.common import texts
from basetide.llm.tokens import default_path, narrow, rank_bytes, rank_encoding, widen

#: Characters of a chunk, and characters that its neighbours share at least.
CHUNK, OVERLAP = 1 << 15, 64

#: A place where every chunk that sees it has a boundary (behind the first character).
_SYNC = re.compile(r"[^\s\x1c-\x1f][ \n]+[^\s\x1c-\x1f]")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def cut_chunks(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of overlapping chunks of a text; without a place to synchronise a chunk grows."""
    out, start, shared = [], 0, 0  # shared: end of the chunk before; the one behind starts no earlier
    while True:
        nxt = max(start + chunk, shared)
        if nxt + overlap >= len(text):
            return [*out, (start, len(text))]
        sync = _SYNC.search(text, nxt + 1)
        if sync is None:
            return [*out, (start, len(text))]
        # some matches behind it, so that the end of the chunk cannot bend the one at the boundary
        shared = min(len(text), sync.end() + overlap)
        out.append((start, shared))
        start = nxt


def boundaries(text: str, pattern) -> np.ndarray:
    """Starts of all matches in ``text`` and its end."""
    return np.array([m.start() for m in pattern.finditer(text)] + [len(text)], np.int64)


def encode_chunk(text: str, encoding, pattern, zone_left: int, zone_right: int):
    """Ids of a chunk with the boundaries of its two zones.

    Returns (ids, left, right): ``left`` and ``right`` are (place, ids before it) pairs of all boundaries up
    to ``zone_left`` and from ``zone_right`` on. Matches inside a zone are encoded one by one, what lies
    between in one call, up to the last boundary with no white space in front: white space is matched by what
    follows it, which the end of a call would hide. Matches behind that boundary are encoded one by one too.
    """
    at = boundaries(text, pattern)
    # the last match may be bent by the chunk's end unless the text ends there; callers never use it
    zone = (at == 0) | (at <= zone_left) | (at >= zone_right)
    marks = at[zone]
    ids, counts = [], []
    for s, e in zip(marks, [*marks[1:], len(text)]):
        counts.append(len(ids))
        inner = at[np.searchsorted(at, s, "right"):np.searchsorted(at, e, "left")]
        singles = [e]
        for m in inner[::-1].tolist():
            if not text[singles[0] - 1].isspace():
                break
            singles.insert(0, m)
        if len(inner) and text[singles[0] - 1].isspace():
            singles.insert(0, s)
        for a, b in zip([s, *singles], singles):
            if b > a:
                ids += encoding.encode_ordinary(text[a:b])
    pairs = list(zip(marks.tolist(), counts))
    return (np.array(ids, np.uint32), [p for p in pairs if p[0] <= zone_left], [p for p in pairs if p[0] >= zone_right])


def join_place(right: list, left: list) -> tuple[int, int]:
    """Ids of the earlier chunk that count and of the later one that do not, from their boundary lists in
    characters of the whole text."""
    theirs = dict(left)
    for place, before in right:
        if place in theirs:
            return before, theirs[place]
    raise ValueError("chunks do not share a boundary")


def bpe_encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
               text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, piece, n_tokens, ids): the ids of every whole text, in one row per chunk; ``piece`` numbers the
    chunks of a text. Texts of one chunk never leave their task; chunks of long texts are dealt over
    the cluster, and each then passes only its ids on to be joined.

    Null and empty texts have one piece without ids. Every row is a document of its own, also where an id or
    a whole row repeats; a null id is kept. Other columns are not read. Pieces of a text stand together
    and in order in one partition.
    """
    ranks, pattern = ranks or default_path("byte_bpe_multi_50k.tiktoken"), pattern or default_pattern()
    rows = texts(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    whole = rows.where(F.length("text") <= chunk + overlap)
    long = rows.where(F.length("text") > chunk + overlap)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoding(ranks, pattern)
        for b in batches:
            ids = [np.array(enc.encode_ordinary(x), np.uint32) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([0] * len(ids), pa.int64()), pa.array([0] * len(ids), pa.int32()),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array([narrow(x) for x in ids], pa.binary())],
                ["id", "key", "piece", "n_tokens", "ids"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column("text").to_pylist()):
                spans = cut_chunks(text, chunk, overlap)
                n = len(spans)
                starts, ends = [s for s, _ in spans], [e for _, e in spans]
                zone_l = [-1, *(ends[k - 1] - starts[k] for k in range(1, n))]
                zone_r = [*(starts[k + 1] - starts[k] for k in range(n - 1)), ends[-1] - starts[-1] + 1]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array([i] * n, pa.int64())), b.column("key").take(pa.array([i] * n, pa.int64())),
                     pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(zone_l, pa.int64()), pa.array(zone_r, pa.int64()), pa.array([text[s:e] for s, e in spans])],
                    ["id", "key", "piece", "n", "start", "zone_l", "zone_r", "text"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        enc, pat = rank_encoding(ranks, pattern), regex.compile(pattern)
        for b in batches:
            ids, left, right = [], [], []
            for text, start, zl, zr in zip(*(b.column(c).to_pylist() for c in ("text", "start", "zone_l", "zone_r"))):
                x, lt, rt = encode_chunk(text, enc, pat, zl, zr)
                ids.append(narrow(x))
                left.append(np.array([(p + start, k) for p, k in lt], np.int64).tobytes())
                right.append(np.array([(p + start, k) for p, k in rt[:-1]], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("id", "key", "piece", "n")), pa.array(left, pa.binary()), pa.array(right, pa.binary()),
                 pa.array(ids, pa.binary())], ["id", "key", "piece", "n", "left", "right", "ids"])

    def pairs(raw: bytes) -> list:
        return np.frombuffer(raw, np.int64).reshape(-1, 2).tolist()

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of a text in order; at most two are held."""
        held, skip = None, 0
        for b in batches:
            keep, out = [], []
            for i, (key, piece, n, left, right, raw) in enumerate(
                    zip(*(b.column(c).to_pylist() for c in ("key", "piece", "n", "left", "right", "ids")))):
                ids = widen(raw)
                if piece:
                    stop, begin = join_place(pairs(held[2]), pairs(left))
                    out.append((held[3], held[0], held[4], held[1][skip:stop]))
                    skip = begin
                else:
                    skip = 0
                held = (piece, ids, right, b.column("id").slice(i, 1), key)
                if piece == n - 1:
                    out.append((held[3], piece, key, ids[skip:]))
                    held = None
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([o[0] for o in out]), pa.array([o[2] for o in out], pa.int64()),
                     pa.array([o[1] for o in out], pa.int32()), pa.array([len(o[3]) for o in out], pa.int64()),
                     pa.array([narrow(o[3]) for o in out], pa.binary())], ["id", "key", "piece", "n_tokens", "ids"])

    schema = f"id {id_type}, key long, piece int, n_tokens long, ids binary"
    # equal rows are counted and numbered, so that every row has a key that a lost task gives it again
    keyed = (long.withColumn("_h", F.xxhash64("id", "text")).groupBy("id", "_h")
             .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("_n"))
             .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
             .select("id", "text", F.xxhash64("_h", "_copy").alias("key")))
    cut = keyed.mapInArrow(
        chunks, f"id {id_type}, key long, piece int, n int, start long, zone_l long, zone_r long, text string")
    coded = cut.repartition("key", "piece").mapInArrow(
        encode, f"id {id_type}, key long, piece int, n int, left binary, right binary, ids binary")
    joined = coded.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(stitch, schema)
    return whole.mapInArrow(short, schema).unionByName(joined)


def digests(pieces: DataFrame, ranks: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): hashes of all ids of a text, as little-endian 32-bit
    integers, and of their decoded bytes. Only texts of several pieces are brought together, in order."""
    ranks = ranks or default_path("byte_bpe_multi_50k.tiktoken")
    id_type = pieces.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rank_bytes(ranks)
        held = None  # [key, id column, count, ids hash, bytes hash]
        for b in batches:
            done = []
            for i, (key, piece, raw) in enumerate(zip(*(b.column(c).to_pylist() for c in ("key", "piece", "ids")))):
                if piece == 0:
                    if held:
                        done.append(held)
                    held = [b.column("id").slice(i, 1), 0, hashlib.sha256(), hashlib.sha256()]
                ids = widen(raw)
                held[1] += len(ids)
                held[2].update(ids.tobytes())
                held[3].update(b"".join(map(table.__getitem__, ids.tolist())))
            if done:
                yield _digest_batch(done)
        if held:
            yield _digest_batch([held])

    schema = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return pieces.mapInArrow(run, schema)


def _digest_batch(done: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64()),
         pa.array([d[2].hexdigest() for d in done]), pa.array([d[3].hexdigest() for d in done])],
        ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
