"""Writers. Output is a directory of part files, in order when an order is part of the format."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.operators.alignment import RECORD_ORDER, meet_areas
from basetide.plans.lineage import shuffles_dropped


def write_bed(df: DataFrame, path: str, columns: Sequence[str] = (), partitions: int | None = None) -> None:
    """Headerless TSV in (chrom, start) order across and within part files."""
    out = df.select(*columns) if columns else df
    cols = ("chrom", "start")
    ranged = out.repartitionByRange(partitions, *cols) if partitions else out.repartitionByRange(*cols)
    # fields stand as they are: the readers know no quotes
    plain = {"sep": "\t", "header": False, "quote": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").options(**plain).csv(path)


def _title(only_species: bool) -> Column:
    return F.col("species") if only_species else F.concat(
        "species", F.lit("."), "scaffold", F.lit(":"), F.col("src_start").cast("string"), F.lit("-"), F.col("src_end").cast("string"))


def fasta_records(aln: DataFrame, only_species: bool = False) -> DataFrame:
    """One row per region: region_id and the FASTA text. A region's group is bounded by its records."""
    text = F.concat(F.lit(">"), _title(only_species), F.lit("\n"), "seq")
    record = F.struct("first_block", "first_row", "copy", text.alias("text"))
    ordered = F.sort_array(F.collect_list(record))
    return aln.groupBy("region_id").agg(F.array_join(F.transform(ordered, lambda r: r["text"]), "\n").alias("value"))


def write_fasta(aln: DataFrame, path: str, only_species: bool = False) -> None:
    """One directory ``region=...`` per region holding its FASTA text."""
    (fasta_records(aln, only_species).withColumnRenamed("region_id", "region")
     .write.mode("overwrite").partitionBy("region").text(path))


def write_fasta_batches(aln: DataFrame, path: str, only_species: bool = False, partitions: int | None = None, placed: bool = False,
                        compression: str = "none") -> None:
    """FASTA files of many regions each, for more regions than a store likes folders. The title ends with
    the region's name; regions and their records keep their order. No region is gathered in one row. With ``placed`` the
    regions lie in their order already (``fetch_regions`` with ``ordered``), and texts are not moved once more."""
    order = ("region_id", *RECORD_ORDER)
    ranged = aln if placed else aln.repartitionByRange(partitions, *order) if partitions else aln.repartitionByRange(*order)
    text = F.concat(F.lit(">"), _title(only_species), F.lit(" "), "region_id", F.lit("\n"), "seq")
    with shuffles_dropped(aln.sparkSession):
        (ranged.sortWithinPartitions(*order).select(text.alias("value")).write.mode("overwrite").option("compression", compression)
         .text(path))


def ss_lines(header: DataFrame, patterns: DataFrame) -> DataFrame:
    """Lines of a site-pattern file with LENGTH and NTUPLES recomputed; (ord, value)."""
    totals = patterns.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("LENGTH"), F.count(F.lit(1)).alias("NTUPLES"))
    fresh = totals.select(F.explode(F.map_from_arrays(
        F.array(F.lit("LENGTH"), F.lit("NTUPLES")), F.array(F.col("LENGTH").cast("string"), F.col("NTUPLES").cast("string"))
    )).alias("key", "_new"))
    rank = F.when(F.col("key") == "NSEQS", 0).when(F.col("key") == "LENGTH", 1).when(F.col("key") == "NTUPLES", 2).otherwise(3)
    head = header.join(fresh, "key", "left").select(
        (rank - 10).cast("long").alias("ord"), F.concat_ws(" = ", "key", F.coalesce("_new", "value")).alias("value"))
    blank = totals.select(F.lit(-1).cast("long").alias("ord"), F.lit("").alias("value"))
    body = patterns.select(F.col("idx").alias("ord"), F.concat_ws(
        "\t", F.col("idx").cast("string"), "pattern", F.col("n").cast("string")).alias("value"))
    return head.union(blank).union(body)


def write_ss(header: DataFrame, patterns: DataFrame, path: str) -> None:
    (ss_lines(header, patterns).repartitionByRange("ord").sortWithinPartitions("ord").select("value")
     .write.mode("overwrite").text(path))


def maf_text(rows: Column | str = "rows") -> Column:
    """Block rows as alignment text, with the "a" line and a closing blank line."""
    r = F.col(rows) if isinstance(rows, str) else rows
    lines = F.transform(r, lambda x: F.concat_ws(
        " ", F.lit("s"), F.concat_ws(".", x["species"], F.nullif(x["scaffold"], F.lit(""))), x["start"].cast("string"),
        x["size"].cast("string"), x["strand"], x["src_size"].cast("string"), x["text"]))
    return F.concat(F.lit("a\n"), F.array_join(lines, "\n"), F.lit("\n"))


def split_blocks(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """Blocks with the region each one meets: (chrom, win, start, rows). Regions have a ``win`` name;
    a block that spans several regions goes to each of them."""
    met = meet_areas(blocks.select("chrom", "start", "size", "rows"), regions.select("chrom", "start", "end", "win"))
    return met.select("chrom", F.explode("areas.win").alias("win"), "start", "rows")


def write_maf_partitioned(blocks: DataFrame, path: str, regions: DataFrame | None = None, max_blocks: int = 100_000) -> None:
    """Alignment text split into directories per chromosome, or per chromosome and region.

    Tasks take ranges of positions, so a hot chromosome is several files that follow each other, and a file holds
    ``max_blocks`` blocks at most. ``readers.read_maf`` with ``partitions`` reads the directories back."""
    keys = ["chrom"] if regions is None else ["chrom", "win"]
    df = blocks if regions is None else split_blocks(blocks, regions)
    (df.repartitionByRange(*keys, "start").sortWithinPartitions(*keys, "start").select(*keys, maf_text().alias("value"))
     .write.mode("overwrite").option("maxRecordsPerFile", max_blocks).partitionBy(*keys).text(path))


def write_maf_archive(blocks: DataFrame, path: str, regions: DataFrame, max_blocks: int = 100_000,
                      spans: DataFrame | None = None) -> None:
    """``write_maf_partitioned`` for very many regions: the same files as rows (chrom, win, file_no, text) of one Parquet table.

    Where each region is a directory, time goes into opening files, some milliseconds each, and their list into the driver.
    Here both grow with the bytes only. A file holds ``max_blocks`` blocks at most, in order of their starts; a region is
    written by one task, as a stream. ``spans``: see ``meet_areas``. ``readers.read_maf_archive`` reads the table back."""
    text = blocks.select("chrom", "start", "size", maf_text().alias("value"))  # far smaller than the rows
    met = meet_areas(text, regions.select("chrom", "start", "end", "win"), spans=spans)
    split = met.select("chrom", F.explode("areas.win").alias("win"), "start", "value")
    dealt = split.repartition("chrom", "win").sortWithinPartitions("chrom", "win", "start").select("chrom", "win", "value")
    kinds = ", ".join(f"{c} {dealt.schema[c].dataType.simpleString()}" for c in ("chrom", "win"))

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, number, held, types = None, 0, [], None
        for b in batches:
            types, out = b.schema, []
            for chrom, win, value in zip(*(c.to_pylist() for c in b.columns)):
                if held and ((chrom, win) != region or len(held) == max_blocks):
                    out.append((*region, number, "".join(held)))
                    number, held = number + 1, []
                if (chrom, win) != region:
                    region, number = (chrom, win), 0
                held.append(value + "\n")
            yield rows(out, types)
        if held:
            yield rows([(*region, number, "".join(held))], types)

    def rows(found: list[tuple], types: pa.Schema) -> pa.RecordBatch:
        cols = list(zip(*found)) if found else [[]] * 4
        kinds = (types.field(0).type, types.field(1).type, pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], ["chrom", "win", "file_no", "text"])

    dealt.mapInArrow(files, f"{kinds}, file_no int, text string").write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header: filled sample sheets, tree tables."""
    df.write.mode("overwrite").option("header", True).csv(path)


write_tree_info = write_csv


def write_samples(filled: DataFrame, path: str, average_path: str | None = None) -> None:
    """Sample sheet with its gc column, "NA" where missing; optionally the average as one number."""
    from basetide.operators.samples import avg_gc

    text = filled.drop("gc_source").withColumn("gc", F.coalesce(F.col("gc").cast("string"), F.lit("NA")))
    write_csv(text, path)
    if average_path:
        avg_gc(filled).select(F.col("avg_gc").cast("string").alias("value")).write.mode("overwrite").text(average_path)


def hmm_log_lines(summary: DataFrame, command: str = "hmm_segment") -> DataFrame:
    """Lines of a segmentation log: a command line and a header, both marked ``# ``, then one line
    per parameter set and chromosome; (param_id, chrom, value) with the marked lines first."""
    from basetide.sources.readers import HMM_LOG

    names = [part.split()[0] for part in HMM_LOG.split(",")]
    body = summary.select("param_id", "chrom", F.concat_ws("\t", *[F.col(n).cast("string") for n in names]).alias("value"))
    head = summary.sparkSession.createDataFrame(
        [(-2, "", f"# Command: {command}"), (-1, "", "# " + "\t".join(names))], "param_id int, chrom string, value string")
    return head.union(body)


def write_hmm_log(summary: DataFrame, path: str, command: str = "hmm_segment") -> None:
    order = ("param_id", "chrom")
    (hmm_log_lines(summary, command).repartitionByRange(*order).sortWithinPartitions(*order).select("value")
     .write.mode("overwrite").text(path))
