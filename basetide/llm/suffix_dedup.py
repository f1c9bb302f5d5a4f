"""Removal of repeated substrings by prefix doubling over sparse positions.

A string of ``length`` bytes is repeated if it also starts earlier: in a smaller document or further left in
the same one. Ranks only serve to tell equal strings from different ones, so a *name* (a 64-bit hash made
by doubling: the name of 2h bytes comes from the names of h bytes at p and p + h) stands for a rank, and
rounds of Spark sorts over (position, name) pairs drop positions as soon as their string is unique.

Positions are sparse. Among the ``length - k + 1`` k-byte strings inside a window of ``length`` bytes the one
with the smallest name (leftmost among equals) is the window's *anchor*. Equal windows have equal anchors
at equal offsets, and neighbouring windows mostly share theirs, so one row stands for a run of windows.

1. Rank of k bytes at the anchor. Anchors whose k bytes are unique end here.
2. Rank of the whole run of windows around the anchor (pairs of growing length up to the run's span). Runs
   equal to an earlier run are removed whole, whatever their number; the first run of each class stays.
3. First runs whose anchor still occurs in another class are opened into bins of windows. A bin is ranked by what
   all its windows share (its core) and by what they cover together (its span): bins with an earlier span are
   removed whole, and cores that no other span has are unique and done.
4. First bins whose core has other spans are opened into windows, ranked by the name of their ``length`` bytes.

Names that decide are pairs of 64 bits. Equal strings met in one batch of documents are settled there, so a
passage that very many documents share reaches the sorts once per batch and not once per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basetide.llm.common import stored, texts

#: Bytes named at a time; longer texts are taken in slices that overlap by a window.
SLICE = 1 << 20
#: Windows of a bin, and runs opened at a time.
BIN, RUNS = 8, 1 << 13

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# rows between the rounds
CANDIDATE, KNOWN_REPEAT, MARKER, REMOVED = 0, 1, 2, 3


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * _C1
    z += y
    z ^= z >> np.uint64(32)
    z *= _C2
    z ^= z >> np.uint64(29)
    return z


_BYTE_NAMES = _mix(np.arange(1, 257, dtype=np.uint64), np.arange(257, 513, dtype=np.uint64))


def names(a: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Names of the strings of each length at every place of ``a``, by doubling."""
    top, out = max(lengths), {}
    h, now = 1, _BYTE_NAMES[a]
    while True:
        for n in lengths:
            if n == h:
                out[n] = now
            elif h < n < 2 * h:
                out[n] = _mix(now[:len(a) - n + 1], now[n - h:]) if len(a) >= n else now[:0]
        if 2 * h > top:
            return out
        now = _mix(now[:len(a) - 2 * h + 1], now[h:]) if len(a) >= 2 * h else now[:0]
        h *= 2


def anchor_bytes(length: int) -> int:
    """k: the largest power of two up to a third of the window."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    have, out = 1, v
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchor_runs(a: np.ndarray, valid: np.ndarray, length: int):
    """(lo, hi, anchor, g, s) of the runs of windows with one anchor; windows start where ``valid``.

    ``g`` names the k bytes at the anchor; ``s`` the bytes from the first window's start to the last one's end
    together with the anchor's place in them.
    """
    k = anchor_bytes(length)
    w = length - k + 1
    n_windows = len(a) - length + 1
    if n_windows <= 0 or not valid.any():
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    named = names(a, [k, 2 * k])
    ranked = (named[k] & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(named[k]), dtype=np.uint64)
    anchor = (_sliding_min(ranked, w)[:n_windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(n_windows, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    lo = np.flatnonzero(new & valid)
    last = np.ones(n_windows, bool)
    last[:-1] = (anchor[1:] != anchor[:-1]) | ~valid[1:]
    hi = np.flatnonzero(last & valid)
    at = anchor[lo]
    span, two = hi - lo + length, named[2 * k]
    s = _mix((at - lo).astype(np.uint64), span.astype(np.uint64))
    for i in range(-(-(2 * length - k) // (2 * k))):
        s = _mix(s, two[lo + np.minimum(i * 2 * k, span - 2 * k)])
    return lo, hi, at, named[k][at], s


class _Texts:
    """Documents of a batch as one byte array with their order: by id (null first), then by the hash of the text.
    ``first`` are the rows to look at; rows equal in both are one document."""

    def __init__(self, b: pa.RecordBatch):
        text = b.column("text").cast(pa.large_string())
        self.starts = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        self.bytes = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        self.ids, self.hashes = b.column("id"), b.column("h").to_numpy()
        keys = list(zip(self.ids.to_pylist(), self.hashes.tolist()))
        seen: dict = {}
        self.first = [i for i, key in enumerate(keys) if seen.setdefault(key, i) == i]
        ranked = sorted(self.first, key=lambda i: (keys[i][0] is not None, keys[i][0] if keys[i][0] is not None else 0, keys[i][1]))
        self.rank = np.zeros(len(keys), np.int64)
        self.rank[ranked] = np.arange(len(ranked))

    def slices(self, length: int) -> Iterator[tuple[list[tuple[int, int, int, int]], np.ndarray, np.ndarray]]:
        """Groups of about SLICE bytes: ((document, place in the group, place in the document, windows), bytes, valid)."""
        group, parts, n = [], [], 0
        for i in self.first:
            raw = self.bytes[self.starts[i]:self.starts[i + 1]]
            for s in range(0, max(1, len(raw) - length + 1), SLICE):
                part = raw[s:s + SLICE + length - 1]
                if len(part) < length:
                    continue
                group.append((i, n, s, len(part) - length + 1))
                parts.append(part)
                n += len(part)
                if n >= SLICE:
                    yield self._group(group, parts, n)
                    group, parts, n = [], [], 0
        if group:
            yield self._group(group, parts, n)

    @staticmethod
    def _group(group, parts, n):
        valid = np.zeros(n, bool)
        for _, at, _, windows in group:
            valid[at:at + windows] = True
        return group, np.concatenate(parts), valid


def _places(h: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Place of a string inside the documents of one id: hash of the text above, offset below."""
    return (h.astype(np.int64) << 32) | lo


def _first_of(keys: list[np.ndarray], rank: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Whether a row is the earliest of its equals in the batch."""
    order = np.lexsort((lo, rank, *keys))
    first = np.ones(len(order), bool)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    first[1:] = ~same
    out = np.zeros(len(order), bool)
    out[order] = first
    return out


def _candidates(length: int):
    """Rows (id, at, g, s, kind, windows, offset) of a batch: ``windows`` in the run, ``offset`` of its anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs = _Texts(b)
            doc, lo, n, off, g, s = [], [], [], [], [], []
            for group, a, valid in docs.slices(length):
                r_lo, r_hi, r_at, r_g, r_s = anchor_runs(a, valid[:max(0, len(a) - length + 1)], length)
                starts = np.array([x[1] for x in group])
                of = np.searchsorted(starts, r_lo, "right") - 1
                doc.append(np.array([x[0] for x in group])[of])
                lo.append(r_lo - starts[of] + np.array([x[2] for x in group])[of])
                n.append(r_hi - r_lo + 1)
                off.append(r_at - r_lo)
                g.append(r_g)
                s.append(r_s)
            if not doc:
                continue
            doc, lo, n, off, g, s = map(np.concatenate, (doc, lo, n, off, g, s))
            first = _first_of([s, g], docs.rank[doc], lo)
            kind = np.where(first, CANDIDATE, REMOVED)
            # anchors with several classes here are known to repeat; the others of the batch learn it by a marker
            classes = np.flatnonzero(first)
            _, back, count = np.unique(g[classes], return_inverse=True, return_counts=True)
            kind[classes[count[back] > 1]] = KNOWN_REPEAT
            marked = np.unique(g[kind == KNOWN_REPEAT], return_index=True)[0]
            g[~first] = _mix(g[~first], lo[~first].astype(np.uint64))  # deals the rows that are settled
            at = _places(docs.hashes[doc], lo)
            ids = docs.ids.take(pa.array(doc))
            m = len(marked)
            ids = pa.concat_arrays([ids, pa.nulls(m, ids.type)])
            pad = lambda x, v=0: np.concatenate([x, np.full(m, v, x.dtype)])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(pad(at)), pa.array(np.concatenate([g, marked]).view(np.int64)), pa.array(pad(s).view(np.int64)),
                 pa.array(pad(kind.astype(np.int8), MARKER)), pa.array(pad(n.astype(np.int32))), pa.array(pad(off.astype(np.int32)))],
                ["id", "at", "g", "s", "kind", "windows", "offset"])

    return run


def _opened(length: int, step: int):
    """The runs listed with each text, cut into bins of ``step`` windows by the distance to their anchor, as
    (id, at, core, span, windows, offset, removed)."""
    k = anchor_bytes(length)

    def bins_of(a: np.ndarray, at: np.ndarray, n: np.ndarray, off: np.ndarray):
        """Bins of runs whose bytes stand one behind the other in ``a``, each from ``at`` on: (run, first window and
        windows, offset of the anchor, core, span)."""
        named = names(a, [k, length - step + 1, length])
        p = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
        run = np.repeat(np.arange(len(n)), n)
        anchor = (at + off)[run]
        bins = (anchor - p) // step
        cut = np.flatnonzero(np.append(True, (bins[1:] != bins[:-1]) | (run[1:] != run[:-1])))
        s, e, anchor, j, run = p[cut], p[np.append(cut[1:], len(p)) - 1], anchor[cut], bins[cut], run[cut]
        g = named[k][anchor]
        core = _mix(_mix(named[length - step + 1][anchor - step * j], g), j.astype(np.uint64))
        span = _mix(_mix(named[length][s], named[length][e]), _mix(g, (e - s).astype(np.uint64)))
        return run, s - at[run], e - s + 1, anchor - s, core, span

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs = _Texts(b)
            lists = b.column("runs")
            edges = lists.offsets.to_numpy()
            fields = lists.values
            r_lo, r_n, r_off = (fields.field(c).to_numpy().astype(np.int64) for c in ("lo", "windows", "offset"))
            picked = np.concatenate([np.arange(edges[i], edges[i + 1]) for i in docs.first] or [np.zeros(0, np.int64)])
            owner = np.repeat(docs.first, np.diff(edges)[docs.first])
            out = []
            for c in range(0, len(picked), RUNS):
                r, d = picked[c:c + RUNS], owner[c:c + RUNS]
                size = r_n[r] + length - 1
                at = np.cumsum(size) - size
                a = docs.bytes[np.repeat(docs.starts[d] + r_lo[r] - at, size) + np.arange(size.sum())]
                of, first_window, windows, offset, core, span = bins_of(a, at, r_n[r], r_off[r])
                out.append((d[of], r_lo[r][of] + first_window, windows, offset, core, span))
            if not out:
                continue
            doc, lo, n, off, core, span = map(np.concatenate, zip(*out))
            first = _first_of([span, core], docs.rank[doc], lo)
            core[~first] = _mix(core[~first], lo[~first].astype(np.uint64))  # deals the rows that are settled
            yield pa.RecordBatch.from_arrays(
                [docs.ids.take(pa.array(doc)), pa.array(_places(docs.hashes[doc], lo)), pa.array(core.view(np.int64)),
                 pa.array(span.view(np.int64)), pa.array(n.astype(np.int32)), pa.array(off.astype(np.int32)), pa.array(~first)],
                ["id", "at", "core", "span", "windows", "offset", "removed"])

    return run


def _text_hash(text: Column) -> Column:
    return F.crc32(text.cast("binary")).bitwiseAND(F.lit(0x7FFFFFFF))


def removed_places(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """(id, h, spans): per document with repeats the (start, end) byte ranges to remove, overlapping and unsorted.
    ``docs`` as (id, text, h) is read twice."""
    rows = texts(docs, id_col, text_col).withColumn("h", _text_hash(F.col("text")))
    id_type = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_candidates(length), f"id {id_type}, at long, g long, s long, kind tinyint, windows int, offset int")

    # round 1: anchors that occur once are done
    salt = F.when(F.col("kind").isin(KNOWN_REPEAT, REMOVED), F.col("s")).otherwise(F.lit(0).cast("long"))
    counted = found.withColumn("_salt", salt).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("g", "_salt")))
    kept = stored(counted.where((F.col("kind") != MARKER) & ((F.col("kind") != CANDIDATE) | (F.col("_n") > 1)))
                  .drop("_salt", "_n"), "anchors")

    # round 2: whole runs
    same_run = Window.partitionBy("g", "s")
    place = F.struct("id", "at")
    ranked = stored(kept.where(F.col("kind") != REMOVED).withColumn("_first", F.min(place).over(same_run) == place)
                    .drop("s", "kind"), "runs")
    heads = ranked.where("_first")
    several = heads.groupBy("g").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("g")

    offset = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
    h = F.shiftrightunsigned("at", 32)

    def opened(runs: DataFrame, step: int) -> DataFrame:
        """Bins of the listed runs with ``_gone``: whether an equal span starts earlier."""
        listed = runs.groupBy("id", h.alias("h")).agg(
            F.collect_set(F.struct(offset.alias("lo"), "windows", "offset")).alias("runs"))
        with_text = rows.join(listed, rows["id"].eqNullSafe(listed["id"]) & (rows["h"] == listed["h"])).select(
            rows["id"], rows["h"], "text", "runs")
        bins = with_text.mapInArrow(_opened(length, step), f"id {id_type}, at long, core long, span long, windows int, "
                                                           "offset int, removed boolean")
        same_span = Window.partitionBy("core", "span")
        return bins.withColumn("_gone", F.col("removed") | (F.min(place).over(same_span) != place))

    # rounds 3 and 4: bins of first runs whose anchor has another class, windows of bins whose core has another span
    bins = stored(opened(heads.join(several, "g", "left_semi"), min(BIN, length // 4 + 1)).drop("removed"), "bins")
    first_bins = bins.where(~F.col("_gone"))
    mixed = first_bins.groupBy("core").agg((F.min("span") != F.max("span")).alias("_m")).where("_m").select("core")
    windows = opened(first_bins.join(mixed, "core", "left_semi"), 1)

    whole = lambda df: df.select("id", "at", "windows")
    gone = (whole(kept.where(F.col("kind") == REMOVED)).unionByName(whole(ranked.where(~F.col("_first"))))
            .unionByName(whole(bins.where("_gone"))).unionByName(whole(windows.where("_gone"))))
    return gone.groupBy("id", h.alias("h")).agg(
        F.collect_list(F.struct(offset.alias("start"), (offset + F.col("windows") - 1 + length).alias("end"))).alias("spans"))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union; ranges that touch become one."""
    if not len(spans):
        return []
    x = np.array(sorted(spans), np.int64)
    reach = np.maximum.accumulate(x[:, 1])
    new = np.append(True, x[1:, 0] > reach[:-1])
    return list(zip(x[new, 0].tolist(), reach[np.append(new[1:], True)].tolist()))


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans drawn in to borders of UTF-8 characters, so that what is left is valid text."""
    inside = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
    out = []
    for s, e in spans:
        while inside(s):
            s += 1
        while inside(e):
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def repeated_spans(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a last column ``_spans``: the runs of bytes, as array<struct<start, end>>, covered by strings of
    ``length`` bytes which also start earlier; runs can overlap, ``merge_spans`` makes them maximal.

    Null texts are empty. Order is by id, nulls first; rows that repeat an id are ordered by a hash of their
    text, and rows equal in both are one document and get the same result. Overlapping repeats count,
    strings never cross documents, and all are judged on the input.
    """
    found = removed_places(docs, length, id_col, text_col).select(
        F.col("id").alias("_sd_id"), F.col("h").alias("_sd_h"), F.col("spans").alias("_spans"))
    rows = docs.withColumn("_sd_own", _text_hash(F.coalesce(F.col(text_col), F.lit(""))))
    return rows.join(found, F.col(id_col).eqNullSafe(F.col("_sd_id")) & (F.col("_sd_own") == F.col("_sd_h")), "left").select(
        *docs.columns, F.coalesce("_spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("_spans"))


def dedup_digest(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every document after the removal."""
    rows = repeated_spans(texts(docs, id_col, text_col), length, "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, gone, n, digest = [], [], [], []
            for i in range(b.num_rows):
                raw = b.column("text")[i].as_py().encode("utf-8", "replace")
                spans = merge_spans([(x["start"], x["end"]) for x in b.column("_spans")[i].as_py()])
                size.append(len(raw))
                gone.append(sum(e - s for s, e in spans))
                n.append(len(spans))
                digest.append(hashlib.sha256(_rest(raw, spans)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(x, pa.int64()) for x in (size, gone, n)), pa.array(digest, pa.string())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _rest(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(raw)]
    return b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2]))


def dedup_text(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeats taken out of their texts. Spans are drawn in to whole characters, so that what is
    left is valid text; a null text stays null."""
    rows = repeated_spans(docs, length, id_col, text_col)
    columns = docs.columns
    place = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = []
            for i in range(b.num_rows):
                text = b.column(text_col)[i].as_py()
                spans = b.column("_spans")[i].as_py()
                if spans:
                    raw = text.encode("utf-8", "replace")
                    found = merge_spans([(x["start"], x["end"]) for x in spans])
                    text = _rest(raw, whole_characters(raw, found)).decode("utf-8", "replace")
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.string()) if k == place else b.column(c) for k, c in enumerate(columns)], columns)

    return rows.mapInArrow(run, docs.schema)
