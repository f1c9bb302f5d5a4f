"""Katz backoff language model of order two, counted and evaluated over partitioned tables.

``p(w | h) = d(c) * c / c(h)`` for word pairs seen c times in training, with Good-Turing discounts d for counts up
to ``cutoff``; other pairs back off to ``alpha(h) * p(w)``, where alpha makes the sum over all words exactly
one. The unigrams at the bottom are add-one estimates over the V training words and one unknown word:
``p(w) = (c + 1) / (N + V + 1)``.

1. Words are 64-bit hashes made from the bytes of a batch at once. Their training counts are one aggregate, and
   words are numbered by falling count, so that the number of a word tells its count: a table of distinct
   counts, of which there are fewer than sqrt(2 N), is all that tasks need to know.
2. Documents are dealt to batches of bounded bytes. Each batch asks for the numbers of its words and then codes its
   word pairs: each pair once, with the documents it stands in. Words outside the training rows share a number.
3. Coded pairs are dealt to buckets by history. A bucket meets a pair's counts of all batches, so it knows c(h, w)
   and alpha(h), scores every pair and returns sums per document. A history with more than a
   ten-thousandth of all tokens is split over several buckets, and its two sums travel apart.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.llm.common import partition_bases, stored

#: Bytes of text of a batch and behind a bucket.
BATCH_BYTES, BUCKET_BYTES = 12 << 20, 8 << 20
#: Histories of more than this share of the tokens are split (and of HOT tokens at least).
HOT, HOT_SHARE = 1 << 20, 10_000

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_B = 0x2545F4914F6CDD1D | 1
END = np.uint64(1)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(31))) * _C1
    z = (z ^ (z >> np.uint64(29))) * _C2
    return z ^ (z >> np.uint64(32))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_STEP = 1 << 20


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for b in (_B, pow(_B, -1, 1 << 64)):
        p = np.full(_STEP, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of ASCII-lower-cased text: polynomials of its bytes, mixed with the length."""
    a = np.frombuffer(raw.lower(), np.uint8)
    space = np.concatenate([[True], _SPACE[a], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers()
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):  # stretches of up to _STEP bytes; a longer word is hashed on its own
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + _STEP, "right")))
        if ends[hi - 1] - base > _STEP:
            import xxhash

            out[lo] = xxhash.xxh64_intdigest(a[starts[lo]:ends[lo]].tobytes())
        else:
            part = a[base:ends[hi - 1]]
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[part] * power[:len(part)], dtype=np.uint64)])
            s, e = starts[lo:hi] - base, ends[lo:hi] - base
            out[lo:hi] = _mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        lo = hi
    return np.maximum(out, np.uint64(2))


def _tokens(raws: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, lengths): all tokens of the texts, an end behind each, and tokens per text."""
    parts = [np.append(word_hashes((t or "").encode("utf-8", "replace")), END) for t in raws]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array([len(p) for p in parts], np.int64)


# arrays of a bucket row: unsigned integers as byte planes, of which the high ones compress to little

def _pack(*arrays: np.ndarray) -> bytes:
    out = []
    for x in arrays:
        x = np.ascontiguousarray(x, "<u8")
        width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
        out += [np.array([width, len(x)], "<u8").tobytes(), x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    return b"".join(out)


def _unpack(raw: bytes, n: int) -> list[np.ndarray]:
    out, at = [], 0
    for _ in range(n):
        width, size = np.frombuffer(raw, "<u8", 2, at).tolist()
        x = np.zeros((size, 8), np.uint8)
        x[:, :width] = np.frombuffer(raw, np.uint8, width * size, at + 16).reshape(width, size).T
        out.append(x.view("<u8").ravel())
        at += 16 + width * size
    return out


class Counts:
    """Training counts by word number: numbers fall into stretches of equal counts, the largest first. ``unknown`` is
    the number of all other words, ``start`` that of the beginning of a text (which stands before every
    training text once)."""

    def __init__(self, counts: list[int], words: list[int], n_docs: int):
        self.counts, self.ends = np.append(np.array(counts, np.int64), 0), np.cumsum(np.array(words, np.int64))
        self.n_docs = n_docs
        self.n_tokens, self.n_words = int((self.counts[:-1] * np.array(words, np.int64)).sum()), int(sum(words))
        self.unknown, self.start = self.n_words, self.n_words + 1
        self.total = float(self.n_tokens + self.n_words + 1)

    def __call__(self, number: np.ndarray) -> np.ndarray:
        number = number.astype(np.int64)
        out = self.counts[np.searchsorted(self.ends, np.minimum(number, self.unknown), "right")]
        return np.where(number == self.start, self.n_docs, out)


def _bucket_of(h: np.ndarray, w: np.ndarray, c_h: np.ndarray, hot: int, buckets: int) -> np.ndarray:
    salts = np.uint64(1) + c_h.astype(np.uint64) // np.uint64(hot)
    salt = np.where(salts > 1, _mix(w + np.uint64(7)) % salts, np.uint64(0))
    return (_mix(h + np.uint64(1) + salt * _C2) % np.uint64(buckets)).astype(np.int64)


def code_batch(texts_: list[str], train: np.ndarray, places: np.ndarray, numbers: np.ndarray, counts: Counts, hot: int, buckets: int):
    """Document sums and coded pairs of a batch.

    ``numbers`` are those of the training words at ``places`` among the sorted distinct hashes of the batch.
    Returns (tokens, known, base scores) per document and {bucket: bytes}.
    """
    tokens, lengths = _tokens(texts_)
    words, at = np.unique(tokens, return_inverse=True)
    del tokens
    kind = np.uint32 if counts.start < 1 << 32 else np.uint64
    number = np.full(len(words), counts.unknown, kind)
    number[places] = numbers
    w = number[at]
    doc = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths)
    c = counts(number)
    sums = lambda x: np.bincount(doc, x[at], len(lengths))
    stats = lengths, sums(c > 0).astype(np.int64), sums(np.log10((c + 1) / counts.total))
    del at, words, number, c
    h = np.append(kind(0), w[:-1])
    h[np.cumsum(lengths) - lengths] = counts.start
    span = np.uint64(counts.n_words + 2)
    if (counts.n_words + 2) ** 2 < 1 << 64:
        order = np.argsort(h * span + w.astype(np.uint64), kind="stable")  # documents stay in order
    else:
        order = np.lexsort((w, h))
    h, w, doc = h[order], w[order], doc[order]
    new_pair = np.append(True, (h[1:] != h[:-1]) | (w[1:] != w[:-1]))
    new = np.flatnonzero(new_pair | np.append(True, doc[1:] != doc[:-1]))
    n = np.diff(np.append(new, len(h)))  # times the pair stands in the document
    h, w, doc, new_pair = h[new], w[new], doc[new], new_pair[new]
    first = np.flatnonzero(new_pair)
    postings = np.diff(np.append(first, len(h)))
    h, w = h[first].astype(np.uint64), w[first].astype(np.uint64)
    bucket = _bucket_of(h, w, counts(h), hot, buckets)
    marked = 2 * doc + train[doc].astype(np.uint32)
    out = {}
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    ends = np.cumsum(postings)
    for k in range(buckets):
        p = order[edges[k]:edges[k + 1]]
        if not len(p):
            continue
        m = postings[p]
        rows = np.repeat(ends[p] - m - (np.cumsum(m) - m), m) + np.arange(m.sum())
        run = np.flatnonzero(np.append(True, h[p][1:] != h[p][:-1]))
        out[k] = _pack(h[p][run], np.diff(np.append(run, len(p))), w[p], m, marked[rows], n[rows])
    return stats, out


class _Bucket:
    """All pairs of a bucket over its batches."""

    def __init__(self, blobs: list[bytes], counts: Counts):
        parts = [_unpack(b, 6) for b in blobs]
        cat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.uint64)
        h = cat([np.repeat(p[0], p[1].astype(np.int64)) for p in parts])
        w, m = cat([p[2] for p in parts]), cat([p[3] for p in parts]).astype(np.int64)
        self.docs = cat([p[4] for p in parts]).astype(np.int64)
        self.n = cat([p[5] for p in parts]).astype(np.int64)
        self.sizes = [int(p[3].sum()) for p in parts]  # postings of each batch
        self.pair_of = np.repeat(np.arange(len(m)), m)
        trained = np.bincount(self.pair_of, self.n * (self.docs & 1), len(m)).astype(np.int64)
        order = np.lexsort((w, h))
        new = np.append(True, (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])) if len(h) else np.zeros(0, bool)
        kind = np.cumsum(new) - 1
        self.type_of = np.empty(len(h), np.int64)
        self.type_of[order] = kind
        first = order[np.flatnonzero(new)]
        self.c = np.bincount(self.type_of, trained, len(first)).astype(np.int64)
        self.h, self.c_w = h[first], counts(w[first])
        self.c_h = counts(self.h)
        starts = np.flatnonzero(np.append(True, self.h[1:] != self.h[:-1])) if len(first) else np.zeros(0, np.int64)
        self.starts = starts
        self.h_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(first))))

    def per_history(self, cutoff: int, total: float) -> tuple[np.ndarray, np.ndarray]:
        """Of each history: pairs seen 1 .. cutoff times, and the unigram mass of all its seen words."""
        k = len(self.starts)
        seen = self.c > 0
        times = np.stack([np.bincount(self.h_of, self.c == r, k) for r in range(1, cutoff + 1)], axis=1)
        return times, np.bincount(self.h_of, np.where(seen, (self.c_w + 1) / total, 0), k)


def discounts(times: np.ndarray, cutoff: int) -> np.ndarray:
    """d(1 .. cutoff) from the numbers of pairs seen 1 .. cutoff + 1 times, by Katz. Where the counts are too few for
    values between 0 and 1, the cutoff is lowered and higher counts stay as they are."""
    for k in range(cutoff, 0, -1):
        n = times[:k + 1].astype(float)
        if (n <= 0).any():
            continue
        r = np.arange(1, k + 1)
        common = (k + 1) * n[k] / n[0]
        if common >= 1:
            continue
        d = ((r + 1) * n[1:] / (r * n[:-1]) - common) / (1 - common)
        if ((d > 0) & (d < 1)).all():
            return np.append(d, np.ones(cutoff - k))
    return np.ones(cutoff)


def score_bucket(b: _Bucket, d: np.ndarray, heavy: dict, hot: int, total: float) -> np.ndarray:
    """log10 probability of each pair (type)."""
    cutoff = len(d)
    times, mass_p = b.per_history(cutoff, total)
    hs, ch = b.h[b.starts], b.c_h[b.starts]
    for i in np.flatnonzero(ch >= hot):
        times[i], mass_p[i] = heavy[int(hs[i])]
    left = times @ ((1 - d) * np.arange(1, cutoff + 1))  # counts taken from seen pairs
    plain = left <= 0  # nothing taken: one more count makes room
    denom = np.where(plain, ch + 1, ch).astype(float)
    left = np.where(plain, 1.0, left)
    alpha = np.where(ch > 0, left / np.maximum(denom, 1) / np.maximum(1 - mass_p, 1e-300), 1.0)
    factor = np.where((b.c <= cutoff) & (b.c > 0), np.append(1.0, d)[np.minimum(b.c, cutoff)], 1.0)
    seen = b.c > 0
    p = np.where(seen, factor * b.c / np.maximum(denom[b.h_of], 1), alpha[b.h_of] * (b.c_w + 1) / total)
    return np.log10(p)


def score(docs: DataFrame, train: Column, cutoff: int = 5, id_col: str = "doc_id", text_col: str = "text",
          batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_tokens: int = HOT) -> DataFrame:
    """(id, trained, n_tokens, n_known, train_tokens, base_score, score) of all documents.

    ``train``: condition on the columns of ``docs`` that marks training rows (null counts as false). Tokens are
    ASCII-lower-cased words and one end per text; null texts are empty and consist of the end alone. Every row
    counts and is scored on its own, also where an id or a whole row repeats; null ids are kept. Without
    training rows all words are unknown. Columns other than id and text are not carried.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    id_type = rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count_if("train").alias("d")).first()
    batches, buckets = -(-(size["b"] or 0) // batch_bytes) or 1, -(-(size["b"] or 0) // bucket_bytes) or 1
    n_docs = size["d"] or 0

    def count_words(it):
        for b in it:
            tokens, lengths = _tokens(b.column("text").to_pylist())
            keep = np.repeat(b.column("train").to_numpy(zero_copy_only=False).astype(bool), lengths)
            words, n = np.unique(tokens[keep], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    words = rows.mapInArrow(count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("c"))
    # numbered where they lie: the partition of the sort and the place in it are written with each word
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_ = stored(words.orderBy(F.desc("c"), "word").select("word", "c", F.spark_partition_id().alias("part"), place.alias("row")),
                     "words")
    # one row per partition
    numbered = sorted_.join(F.broadcast(partition_bases(sorted_.select("part", F.lit(1).alias("n")), "part", "n", "base")), "part").select(
        "word", (F.col("base") + F.col("row")).alias("number"))
    # fewer than sqrt(2 N) distinct counts
    by_count = sorted_.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()
    counts = Counts([r["c"] for r in by_count], [r["n"] for r in by_count], n_docs)
    n_tokens, total, hot = counts.n_tokens, counts.total, max(hot_tokens, counts.n_tokens // HOT_SHARE)

    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("id", "text"), F.lit(batches)).cast("int"))

    def batch_words(t: pa.Table) -> pa.Table:
        found = np.unique(_tokens(t.column("text").to_pylist())[0])
        n = len(found)
        return pa.table({"batch": pa.array(np.full(n, t.column("batch")[0].as_py()), pa.int32()), "word": pa.array(found.view(np.int64)),
                         "place": pa.array(np.arange(n), pa.int32())})

    asked = dealt.groupBy("batch").applyInArrow(batch_words, "batch int, word long, place int")
    told = asked.join(numbered, "word").select("batch", "place", "number")

    def code(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, raws, train_ = (left.column(x).to_pylist() for x in ("id", "text", "train"))
        # the same order whenever the batch is made again
        order = sorted(range(len(raws)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0, raws[i]))
        flags = np.array([train_[i] for i in order], np.int64)
        places, numbers = right.column("place").to_numpy(), right.column("number").to_numpy().astype(np.uint64)
        stats, out = code_batch([raws[i] for i in order], flags, places, numbers, counts, hot, buckets)
        batch = left.column("batch")[0].as_py()
        named = pa.array([[ids[i] for i in order]], pa.list_(left.schema.field("id").type))
        head = np.concatenate([stats[0], stats[1], flags]).astype("<i8").tobytes() + stats[2].astype("<f8").tobytes()
        none = pa.nulls(len(out), named.type)
        return pa.table({"bucket": pa.array([batch % buckets, *out], pa.int32()), "batch": pa.array([batch] * (1 + len(out)), pa.int32()),
                         "ids": pa.concat_arrays([named, none]), "data": pa.array([head, *out.values()], pa.binary())})

    coded = dealt.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(
        code, f"bucket int, batch int, ids array<{id_type}>, data binary")

    def load(t: pa.Table) -> tuple[_Bucket, list[int]]:
        r = sorted((b, d) for b, i, d in zip(t.column("batch").to_pylist(), t.column("ids").to_pylist(), t.column("data").to_pylist())
                   if i is None)
        return _Bucket([d for _, d in r], counts), [b for b, _ in r]

    def statistics(t: pa.Table) -> pa.Table:
        b, _ = load(t)
        times, mass = b.per_history(cutoff, total)
        coc = np.array([(b.c == r).sum() for r in range(1, cutoff + 2)], float)
        hs, ch = b.h[b.starts], b.c_h[b.starts]
        big = np.flatnonzero(ch >= hot)
        keys = np.append(np.uint64(0), hs[big] + np.uint64(1)).view(np.int64)
        values = [coc, *(np.append(times[i], mass[i]) for i in big)]
        return pa.table({"h": pa.array(keys), "v": pa.array(values, pa.list_(pa.float64()))})

    # one row: pairs by count, and the sums of the split histories (HOT_SHARE of them at most)
    found = coded.groupBy("bucket").applyInArrow(statistics, "h long, v array<double>")
    summed = found.select("h", F.posexplode("v").alias("i", "x")).groupBy("h", "i").agg(F.sum("x").alias("x"))
    summed = summed.groupBy("h").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))
    globals_ = summed.agg(F.collect_list(F.struct("h", "v")).alias("g")).withColumn(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).select("bucket", "g")

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        heads = [(b, i, d) for b, i, d in zip(left.column("batch").to_pylist(), left.column("ids"), left.column("data").to_pylist())
                 if i.is_valid]
        b, names = load(left)
        known = {x["h"]: np.array(x["v"]) for x in (right.column("g")[0].as_py() if right.num_rows else [])}
        d = discounts(known.pop(0, np.zeros(cutoff + 1)), cutoff)
        heavy = {h - 1: (v[:-1], v[-1]) for h, v in known.items()}
        logs = score_bucket(b, d, heavy, hot, total)[b.type_of][b.pair_of] * b.n
        out, at = [], 0
        for name, m in zip(names, b.sizes):
            docs_ = b.docs[at:at + m] >> 1
            sums = np.bincount(docs_, logs[at:at + m])
            hit = np.flatnonzero(np.bincount(docs_))
            out.append((name, hit.astype("<u4").tobytes() + sums[hit].astype("<f8").tobytes()))
            at += m
        kind = left.schema.field("ids").type
        return pa.table({"batch": pa.array([x[0] for x in [*heads, *out]], pa.int32()),
                         "bucket": pa.array([-1] * len(heads) + [left.column("bucket")[0].as_py() if left.num_rows else 0] * len(out), pa.int32()),
                         "ids": pa.concat_arrays([pa.array([i.as_py() for _, i, _ in heads], kind), pa.nulls(len(out), kind)]),
                         "data": pa.array([x[2] for x in heads] + [x[1] for x in out], pa.binary())})

    sums = coded.groupBy("bucket").cogroup(globals_.groupBy("bucket")).applyInArrow(
        evaluate, f"batch int, bucket int, ids array<{id_type}>, data binary")

    def gather(t: pa.Table) -> pa.Table:
        parts = sorted(zip(t.column("bucket").to_pylist(), range(t.num_rows)))
        ids = t.column("ids")[parts[0][1]].values
        head = t.column("data")[parts[0][1]].as_py()
        k = len(ids)
        lengths, known, flags = np.frombuffer(head, "<i8", 3 * k).reshape(3, k)
        base, logs = np.frombuffer(head, "<f8", k, 24 * k), np.zeros(k)
        for _, i in parts[1:]:
            raw = t.column("data")[i].as_py()
            m = len(raw) // 12
            logs[np.frombuffer(raw, "<u4", m)] += np.frombuffer(raw, "<f8", m, 4 * m)
        return pa.table({"id": ids, "trained": pa.array(flags.astype(bool)), "n_tokens": pa.array(lengths), "n_known": pa.array(known),
                         "train_tokens": pa.array(np.full(k, n_tokens), pa.int64()), "base_score": pa.array(base), "score": pa.array(logs)})

    return sums.groupBy("batch").applyInArrow(
        gather, f"id {id_type}, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


__all__ = ["discounts", "score", "word_hashes"]
