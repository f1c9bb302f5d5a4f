"""Line formats whose records may be longer than a task: a header line holds for all lines up to the next one.

Files are read line by line, and file splits are cut anywhere. Inside a split every line counts what stands between its header
and itself; lines in front of the split's first header get the header and the count from the splits before it, by a
scan over one row per split. So a chromosome is spread over as many tasks as its file has splits, and nothing is shuffled
but those lines, or, for up to ``SPLITS`` splits, nothing at all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The rows of the scan are broadcast up to this many splits.
SPLITS = 200_000
_SPLIT = ["file", "split"]


def _lines(spark: SparkSession, path: Sequence[str], **options) -> DataFrame:
    raw = spark.read.options(**options).text(list(path))
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def _split_parts(b: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of rows of one split."""
    if not b.num_rows:
        return
    files, splits = b.column("file").dictionary_encode().indices.to_numpy(), b.column("split").to_numpy()
    edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(splits) != 0)) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows])


def carry(parts: DataFrame, n: Column) -> DataFrame:
    """(file, split, header, before, headers) as they enter each split, from parts (file, split, seg, header) of ``n`` units: the last
    header before the split, the units since then and the number of headers so far. ``seg`` counts the headers of a split."""
    segs = parts.groupBy(*_SPLIT, "seg").agg(F.sum(n).alias("n"), F.max("header").alias("header"))
    splits = segs.groupBy(*_SPLIT).agg(F.max("seg").alias("found"), F.max_by("n", "seg").alias("n"),
                                       F.max_by("header", "seg").alias("last"))
    # one row a split: a file has its size / maxPartitionBytes of them
    order = Window.partitionBy("file").orderBy("split")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    splits = splits.withColumn("headers", F.sum("found").over(so_far))
    since = Window.partitionBy("file", "headers").orderBy("split").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # splits without a header continue the one before them: equal header counts are one record
    splits = splits.withColumn("n", F.sum("n").over(since)).withColumn("last", F.max("last").over(since))
    return splits.select(*_SPLIT, *(F.lag(c).over(order).alias(a) for c, a in (("last", "header"), ("n", "before"), ("headers", "headers"))))


def _with_carry(parts: DataFrame, entering: DataFrame) -> DataFrame:
    """``parts`` with the header and the counts over split borders."""
    entering = entering.select(F.col("file").alias("_f"), F.col("split").alias("_s"), F.col("header").alias("_h"),
                               F.coalesce("before", F.lit(0)).alias("_b"), F.coalesce("headers", F.lit(0)).alias("headers_before"))
    few = entering.count() <= SPLITS
    met = parts.join(F.broadcast(entering) if few else entering, (F.col("file") == F.col("_f")) & (F.col("split") == F.col("_s")), "left")
    opens = F.col("seg") == 0
    return (met.withColumn("header", F.when(opens, F.col("_h")).otherwise(F.col("header")))
            .withColumn("before", F.when(opens, F.col("before") + F.col("_b")).otherwise(F.col("before")))
            .drop("_f", "_s", "_h", "_b"))


def read_genome(spark: SparkSession, path: str | Sequence[str], chunk: int = 1 << 16, files: str = "*.{fa,fasta,fna}") -> DataFrame:
    """FASTA files as (file, record, title, chunk_no, seq): pieces of ``chunk`` letters of each entry, in file order.

    ``record`` numbers the entries of a file from 1. Entries without letters have no piece; text in front of the first title is
    an error. A line must fit in memory, an entry need not.
    """
    lines = _lines(spark, [path] if isinstance(path, str) else path, pathGlobFilter=files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seg, header, before = None, 0, None, 0
        for b in batches:
            out = []
            for lo, hi in _split_parts(b):
                own = (b.column("file")[lo].as_py(), b.column("split")[lo].as_py())
                if own != at:
                    at, seg, header, before = own, 0, None, 0
                value = b.column("value").slice(lo, hi - lo)
                heads = np.flatnonzero(pc.starts_with(value, ">").to_numpy(zero_copy_only=False)).tolist()
                for s, e in zip([-1, *heads], [*heads, hi - lo]):
                    if s >= 0:
                        seg, header, before = seg + 1, value[s].as_py()[1:].strip(), 0
                    text = "".join("".join(value.slice(s + 1, e - s - 1).to_pylist()).split())
                    if text or s >= 0:
                        out.append((*at, seg, header, before, text))
                    before += len(text)
            cols = list(zip(*out)) if out else [[]] * 6
            types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                             ["file", "split", "seg", "header", "before", "text"])

    parts = lines.mapInArrow(run, "file string, split long, seg int, header string, before long, text string")
    placed = _with_carry(parts, carry(parts, F.length("text"))).where(F.length("text") > 0)
    untitled = F.raise_error(F.concat(F.lit("sequence in front of the first title: "), "file")).cast("string")
    record = F.coalesce("headers_before", F.lit(0)) + F.col("seg")
    first, last = F.floor(F.col("before") / chunk), F.floor((F.col("before") + F.length("text") - 1) / chunk)
    pieces = placed.select("file", record.alias("record"), F.coalesce("header", untitled).alias("title"), "before", "text",
                           F.explode(F.sequence(first, last)).alias("chunk_no"))
    start = F.greatest(F.col("before"), F.col("chunk_no") * chunk)
    stop = F.least(F.col("before") + F.length("text"), (F.col("chunk_no") + 1) * chunk)
    cut = F.substring(F.col("text"), (start - F.col("before") + 1).cast("int"), (stop - start).cast("int"))
    keys = ["file", "record", "title", "chunk_no"]
    return (pieces.select(*keys, F.struct(start.alias("at"), cut.alias("seq")).alias("p")).groupBy(*keys)
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["seq"]), "").alias("seq")))


_SKIPPED = r"^(track|browser|#)"


def read_wig_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """fixedStep scores as (header, k, text): the block's header line and each value with its number in the block."""
    lines = _lines(spark, [path] if isinstance(path, str) else path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seg, header, before = None, 0, None, 0
        for b in batches:
            value = pc.utf8_trim_whitespace(b.column("value"))
            words = pc.list_value_length(pc.utf8_split_whitespace(value))
            heads = pc.match_substring_regex(value, r"^(fixedStep|variableStep)")
            skip = pc.or_(pc.equal(value, ""), pc.match_substring_regex(value, _SKIPPED))
            n = np.where(pc.or_(heads, skip).to_numpy(zero_copy_only=False), 0, words.to_numpy(zero_copy_only=False)).astype(np.int64)
            is_head = heads.to_numpy(zero_copy_only=False)
            kept = np.flatnonzero((n > 0) | is_head)
            segs, befores, names = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int64), []
            for lo, hi in _split_parts(b):
                own = (b.column("file")[lo].as_py(), b.column("split")[lo].as_py())
                if own != at:
                    at, seg, header, before = own, 0, None, 0
                starts = np.flatnonzero(is_head[lo:hi])
                here = np.searchsorted(starts, np.arange(hi - lo), "right")
                run_n = np.cumsum(n[lo:hi]) - n[lo:hi]
                base = np.r_[-before, run_n[starts]]
                titles = [header, *value.take(pa.array(lo + starts)).to_pylist()]
                segs[lo:hi], befores[lo:hi] = seg + here, run_n - base[here]
                names.append(pa.array(titles, pa.string()).take(pa.array(here)))
                total = int(n[lo:hi].sum())
                before, header, seg = total - int(base[-1]), titles[-1], seg + len(starts)
            take = pa.array(kept)
            headers = pa.concat_arrays(names) if names else pa.array([], pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column("file").take(take), b.column("split").take(take), pa.array(segs[kept]), headers.take(take), pa.array(befores[kept]),
                 pa.array(n[kept]), value.take(take)], ["file", "split", "seg", "header", "before", "n", "text"])

    parts = lines.mapInArrow(run, "file string, split long, seg int, header string, before long, n long, text string")
    placed = _with_carry(parts, carry(parts, F.col("n"))).where("n > 0 OR text RLIKE '^variableStep'")
    return placed.select("header", "before", F.posexplode(F.split("text", r"\s+")).alias("j", "text")).select(
        "header", (F.col("before") + F.col("j")).alias("k"), "text")
