"""Multiple-alignment blocks: depth, summaries, region extraction, de-duplication and batching.

Blocks are one row each: block_id, chrom, start, size (reference bases) and ``rows``, an array of
struct(species, scaffold, start, size, strand, src_size, text) with the reference row first.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basetide.functions.sequences import gap_count, pad_gaps, region_name, slice_seq, ungapped_length
from basetide.operators.intervals import overlap_join, pack_runs
from basetide.plans.lineage import cut, written
from basetide.plans.ordered import TILE_WIDTH, Scan, ordered_scan, position_tile


def first_per_species(rows: Column | str = "rows") -> Column:
    """The rows of a block without later copies of a species."""
    r = F.col(rows) if isinstance(rows, str) else rows
    names = F.transform(r, lambda x: x["species"])
    firsts = F.filter(r, lambda x, i: F.array_position(names, x["species"]) == i + 1)
    return F.when(F.size(F.array_distinct(names)) == F.size(r), r).otherwise(firsts)


def char_matrix(texts: Sequence[str]) -> np.ndarray:
    """Equally long texts as a matrix of character codes."""
    joined = "".join(texts)
    code, kind = ("latin-1", np.uint8) if joined.isascii() else ("utf-32-le", np.uint32)
    return np.frombuffer(joined.encode(code), dtype=kind).reshape(len(texts), -1)


def _block_depths(blocks_of: Sequence[Sequence[str]], skip_ref_gaps: bool) -> list[np.ndarray]:
    """Species present per column of each block. Blocks of one shape are counted together, ``CELLS`` cells at a time."""
    shapes: dict[tuple[int, int], list[int]] = {}
    for i, texts in enumerate(blocks_of):
        shapes.setdefault((len(texts), len(texts[0])), []).append(i)
        if any(len(t) != len(texts[0]) for t in texts):
            raise ValueError("the texts of a block differ in length")
    out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(blocks_of)
    for (height, width), members in shapes.items():
        if not width:
            continue
        step = max(1, CELLS // (height * width))
        for some in (members[k:k + step] for k in range(0, len(members), step)):
            cells = char_matrix([t for i in some for t in blocks_of[i]]).reshape(len(some), height, width)
            absent = (cells == ord("-")) | (cells == ord("n")) | (cells == ord("N"))
            depths = height - absent.sum(axis=1)
            for i, depth, ref in zip(some, depths, cells[:, 0]):
                out[i] = depth[ref != ord("-")] if skip_ref_gaps else depth
    return out


#: Cells of equally shaped blocks that are counted in one array step.
CELLS = 1 << 22


def _depth_runs(blocks: DataFrame, skip_ref_gaps: bool, edges: bool | None) -> DataFrame:
    """Runs of equal depth inside blocks; with ``edges`` those that touch their block's start or end, or all others."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            depths = _block_depths(pdf["texts"].tolist(), skip_ref_gaps)
            sizes = np.array([d.size for d in depths], dtype=np.int64)
            depth = np.concatenate(depths) if depths else np.empty(0, dtype=np.int64)
            # one pass over the batch: a run ends where the depth changes or the block ends
            owner = np.repeat(np.arange(sizes.size), sizes)
            change = (depth[1:] != depth[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(np.r_[np.ones(min(depth.size, 1), dtype=bool), change])
            last = np.r_[first[1:], depth.size][: first.size]
            ends = np.cumsum(sizes)
            if edges is not None:
                block = owner[first]
                kept = ((first == (ends - sizes)[block]) | (last == ends[block])) == edges
                first, last = first[kept], last[kept]
            block = owner[first]
            shift = pdf["start"].to_numpy()[block] - (ends - sizes)[block]
            yield pd.DataFrame({"chrom": pdf["chrom"].to_numpy()[block], "start": first + shift, "end": last + shift, "depth": depth[first]})

    texts = F.transform(first_per_species(), lambda x: x["text"])
    return (blocks.where(F.size("rows") > 0).select("chrom", "start", texts.alias("texts"))
            .mapInPandas(runs, "chrom string, start long, end long, depth int"))


def maf_depth(blocks: DataFrame, skip_ref_gaps: bool = False) -> DataFrame:
    """Species present per alignment column, as runs of equal depth (chrom, start, end, depth).

    The first row of every species counts; ``-``, ``n`` and ``N`` do not. Blocks are independent, so
    this needs no shuffle, and cells never become rows. Columns where the reference has a gap
    advance the position unless ``skip_ref_gaps``.
    """
    return _depth_runs(blocks, skip_ref_gaps, None)


def packed_depth(blocks: DataFrame, skip_ref_gaps: bool = False, tile_width: int = TILE_WIDTH) -> DataFrame:
    """``maf_depth`` with touching runs of equal depth joined across blocks that do not overlap.

    A run inside a block ends where the depth changes, so only the first and the last run of a block can go on in another
    one. These alone, two a block at most, go through the scans; all others leave their task as they are."""
    edges = cut(_depth_runs(blocks, skip_ref_gaps, True))
    return _depth_runs(blocks, skip_ref_gaps, False).unionByName(pack_runs(edges, "depth", tile_width))


def block_summary(blocks: DataFrame) -> DataFrame:
    """Reference scaffold, start, aligned length, length of the reference text and row count."""
    ref = F.get("rows", F.lit(0))
    return blocks.select("block_id", ref["scaffold"].alias("ref_scaffold"), ref["start"].alias("ref_start"),
                         ref["size"].alias("aln_len"), F.length(ref["text"]).alias("line_len"),
                         F.size("rows").alias("n_seqs"))


def block_composition(blocks: DataFrame) -> DataFrame:
    """Base counts per species over all blocks (later copies of a species left out), block bases
    seen, and the G+C share of A, C, G and T."""
    text = F.upper("r.text")
    rows = blocks.select(F.explode(first_per_species()).alias("r"))
    counts = [F.sum(F.length(text) - F.length(F.replace(text, F.lit(b), F.lit("")))).alias(f"n_{b.lower()}")
              for b in "ACGT"]
    out = rows.groupBy(F.col("r.species").alias("species")).agg(
        F.count(F.lit(1)).alias("blocks"), F.sum(ungapped_length("r.text")).alias("bases"), *counts)
    acgt = F.col("n_a") + F.col("n_c") + F.col("n_g") + F.col("n_t")
    return out.withColumn("gc", F.when(acgt > 0, (F.col("n_c") + F.col("n_g")) / acgt))


def subset_species(blocks: DataFrame, species: Sequence[str], unique: bool = True) -> DataFrame:
    """Keep the named species in every block, once each when ``unique``; blocks left empty go."""
    wanted = F.array(*[F.lit(s) for s in species])
    rows = first_per_species() if unique else F.col("rows")
    kept = F.filter(rows, lambda r: F.array_contains(wanted, r["species"]))
    return blocks.withColumn("rows", kept).where(F.size("rows") > 0)


def meet_areas(blocks: DataFrame, areas: DataFrame, bin_width: int | None = None, spans: DataFrame | None = None) -> DataFrame:
    """Blocks that overlap an area (chrom, start, end and more columns), with ``areas``, the list of all they overlap.

    Coordinates alone go through the interval join; the rows of a block are moved once, by one equi-join, however many
    areas it meets, and not at all where it meets none. The join counts lengths, classes and bins before it meets, so
    coordinates and areas are written once and read from there. ``spans`` (chrom, start, size) are the coordinates of all
    blocks where an index knows them; otherwise they are read from the blocks."""
    keys = ["chrom", "start", "size"]
    known = blocks if spans is None else spans
    spans = written(known.select(*keys, (F.col("start") + F.col("size")).alias("end")).distinct(), "spans")
    areas = written(areas, "areas")
    rest = [c for c in areas.columns if c != "chrom"]
    met = (overlap_join(areas, spans, bin_width=bin_width)
           .groupBy("chrom", F.col("b_start").alias("start"), F.col("b_size").alias("size"))
           .agg(F.collect_list(F.struct(*rest)).alias("areas")))
    return blocks.join(met, keys).select(*blocks.columns, "areas")


def fetch_regions(blocks: DataFrame, regions: DataFrame, join_dist: int = 100, ref: str = "ref",
                  bin_width: int | None = None, spans: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """Stitched alignment of every region: one row per (region, species, scaffold, copy).

    Blocks meet regions through ``meet_areas`` (``spans``: their coordinates, where known); each block is cut to the region and moved
    to it as one row, and rows of one (region, species, scaffold) are folded there in block order. With ``ordered`` the regions
    lie in ranges of region_id, one partition behind the other. A piece extends the first
    copy whose last source position is less than ``join_dist`` away and that was not extended in
    this block; otherwise it opens a new copy. Bases a copy does not cover are gaps, so every
    sequence is as long as its region. A met block whose reference row is longer than its size (it holds gaps)
    is an error. The group is bounded by the region: at most one piece per region base and source copy.

    Output: region_id, chrom, start, end, species, scaffold, copy, src_start, src_end, seq and the
    file order of the record (first_block, first_row, copy).
    """
    areas = regions.select("chrom", "start", "end").distinct()
    fits = F.length(F.get("rows", F.lit(0))["text"]) == F.col("size")
    bare = blocks.select("chrom", "start", "size", F.transform("rows", lambda r: F.struct(
        r["species"].alias("species"), r["scaffold"].alias("scaffold"), r["start"].alias("start"), r["text"].alias("text"))).alias("rows"))
    met = (meet_areas(bare, areas, bin_width, spans)
           .select("chrom", F.col("start").alias("b_start"), (F.col("start") + F.col("size")).alias("b_end"), fits.alias("fits"), "rows",
                   F.explode("areas").alias("area"))
           .select("chrom", "area.*", "b_start", "fits", "rows", F.greatest("start", "b_start").alias("at"),
                   F.least("end", "b_end").alias("to")))
    offset = F.col("at") - F.col("b_start")
    # positions are columns only where the reference row has no gap; asked behind the join, where only met blocks are left
    gapped = F.raise_error(F.concat(F.lit("reference gaps in the block at "), "chrom", F.lit(":"), F.col("b_start").cast("string")))
    inside = F.transform("rows", lambda r: F.struct(
        r["species"].alias("species"), r["scaffold"].alias("scaffold"), r["start"].alias("src"),
        (r["start"] + ungapped_length(r["text"])).alias("src_last"),
        F.when(F.col("fits"), slice_seq(r["text"], offset, F.col("to") - F.col("b_start"))).otherwise(gapped.cast("string")).alias("seq")))
    region = ["region_id", "chrom", "start", "end"]
    cuts = met.select(region_name(ref, "chrom", "start", "end").alias("region_id"), "chrom", "start", "end", "at", offset.alias("offset"), inside.alias("rows"))
    dealt = cuts.repartitionByRange("region_id") if ordered else cuts.repartition(*region)
    pieces = dealt.select(*region, "at", "offset", F.posexplode("rows").alias("row_no", "r"))
    piece = F.struct(F.col("at"), F.col("row_no"), F.col("r.src").alias("src"), F.col("offset"), F.col("r.src_last").alias("src_last"),
                     F.col("r.seq").alias("seq"))
    groups = (pieces.groupBy(*region, F.col("r.species").alias("species"), F.col("r.scaffold").alias("scaffold"))
              .agg(F.sort_array(F.collect_list(piece)).alias("pieces")))

    def opened(p: Column) -> Column:
        lead = p["at"] - F.col("start")
        return F.struct(p["src_last"].alias("last"), p["at"].alias("at"), p["at"].alias("first_block"),
                        p["row_no"].alias("first_row"), (p["src"] + p["offset"]).alias("src_start"),
                        F.concat(pad_gaps(lead), p["seq"]).alias("seq"))

    def extended(c: Column, p: Column) -> Column:
        hole = p["at"] - F.col("start") - F.length(c["seq"])
        return F.struct(p["src_last"].alias("last"), p["at"].alias("at"), c["first_block"], c["first_row"],
                        c["src_start"], F.concat(c["seq"], pad_gaps(hole), p["seq"]).alias("seq"))

    def step(copies: Column, p: Column) -> Column:
        fits = F.transform(copies, lambda c: (F.abs(c["last"] - p["src"]) < join_dist) & (c["at"] != p["at"]))
        hit = F.array_position(fits, True)
        return F.when(hit > 0, F.transform(copies, lambda c, i: F.when(i + 1 == hit, extended(c, p)).otherwise(c))
                      ).otherwise(F.concat(copies, F.array(opened(p))))

    # where every piece extends the one before it there is one copy, laid down at once: the fold copies it at each step
    before = lambda i: F.get("pieces", i - 1)
    follows = lambda p, i: (i == 0) | ((F.abs(before(i)["src_last"] - p["src"]) < join_dist) & (before(i)["at"] < p["at"])
                                       & (before(i)["at"] + F.length(before(i)["seq"]) <= p["at"]))
    hole = lambda p, i: p["at"] - F.when(i == 0, F.col("start")).otherwise(before(i)["at"] + F.length(before(i)["seq"]))
    one = F.get("pieces", F.lit(0))
    end = F.element_at("pieces", -1)
    whole = F.array_join(F.transform("pieces", lambda p, i: F.concat(pad_gaps(hole(p, i)), p["seq"])), "")
    single = F.array(F.struct(end["src_last"].alias("last"), end["at"].alias("at"), one["at"].alias("first_block"), one["row_no"].alias("first_row"),
                              (one["src"] + one["offset"]).alias("src_start"), whole.alias("seq")))
    in_line = ~F.exists(F.transform("pieces", follows), lambda x: ~x)

    empty = F.expr("cast(array() as array<struct<last: bigint, at: bigint, first_block: bigint, first_row: int, "
                   "src_start: bigint, seq: string>>)")
    folded = groups.select(*region, "species", "scaffold",
                           F.posexplode(F.when(in_line, single).otherwise(F.aggregate("pieces", empty, step))).alias("copy", "c"))
    tail = F.col("end") - F.col("start") - F.length("c.seq")
    out = folded.withColumn("seq", F.concat("c.seq", pad_gaps(tail)))
    return out.select(*region, "species", "scaffold", "copy", "c.first_block", "c.first_row", "c.src_start",
                      (F.col("c.src_start") + ungapped_length("seq")).alias("src_end"), "seq")


RECORD_ORDER = ("first_block", "first_row", "copy")


def dedup_species(aln: DataFrame, region: str = "region_id", order: Sequence[str] = RECORD_ORDER) -> DataFrame:
    """Per (region, species), the record with fewest gaps; the first in file order on a tie.

    A rank limit of one, which already holds inside map tasks: sequences are exchanged for one record per task and key at
    most, and no aggregate carries them in its buffer."""
    gaps = F.col("gaps") if "gaps" in aln.columns else gap_count("seq")
    first = Window.partitionBy(region, "species").orderBy("_g", *order)
    ranked = aln.withColumn("_g", gaps).withColumn("_rank", F.row_number().over(first))
    rest = [c for c in aln.columns if c not in (region, "species")]
    return ranked.where("_rank = 1").select(region, "species", *rest)


def _sequence_counts(aln: DataFrame, region: str) -> DataFrame:
    return aln.groupBy(region).agg(F.count(F.lit(1)).alias("n_seqs"))


def complete_regions(aln: DataFrame, n: int, region: str = "region_id") -> DataFrame:
    """Records of the regions that have exactly n records; n = 0 keeps all."""
    if not n:
        return aln
    full = _sequence_counts(aln, region).where(F.col("n_seqs") == n).select(region)
    return aln.join(full, region, "left_semi")


def region_bed(aln: DataFrame) -> DataFrame:
    return aln.select("chrom", "start", "end").distinct()


def seqs_per_alignment(aln: DataFrame, region: str = "region_id") -> DataFrame:
    """How many alignments have 1, 2, 3 ... records."""
    return _sequence_counts(aln, region).groupBy("n_seqs").agg(F.count(F.lit(1)).alias("n_alignments"))


def prune_species(aln: DataFrame, prune: DataFrame) -> DataFrame:
    """Drop the records of the listed species."""
    return aln.join(prune.select("species").distinct(), "species", "left_anti").select(aln.columns)


def batch_loci(loci: DataFrame, size: int = 20, order: Sequence[str] = ("chrom", "start", "name"),
               tile_width: int = TILE_WIDTH) -> DataFrame:
    """Number loci in order, group them by ``size`` and give offsets into the concatenated batch.

    Input: chrom, start, end, name. The running number is a tiled scan; offsets run inside one
    batch of ``size`` rows."""
    rows = (loci.withColumn("_tile", position_tile("start", tile_width)).withColumn("_one", F.lit(1).cast("long"))
            .withColumn("_chrom", F.col("chrom")))
    inner = [c for c in order if c != "chrom"]
    numbered = ordered_scan(rows, [], inner, ["_chrom", "_tile"], [Scan("idx", "sum", "_one", inclusive=False)])
    length = F.col("end") - F.col("start")
    w = Window.partitionBy("batch_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    out = numbered.withColumn("batch_id", F.floor(F.col("idx") / size) + 1).withColumn("_to", F.sum(length).over(w))
    return out.select("batch_id", "idx", (F.col("_to") - length).alias("start"), F.col("_to").alias("end"), "name")


#: Letters of a genome piece. A slice reads its pieces from their start, so pieces are short.
CHUNK = 1 << 16


def chunk_genome(fasta: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(title, seq) -> (chrom, chunk_no, seq) pieces of fixed length, by one pass over each text. ``readers.read_genome`` makes
    them from files without a row per chromosome."""
    pieces = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    return fasta.where(F.length("seq") > 0).select(F.col("title").alias("chrom"), F.posexplode(pieces).alias("chunk_no", "seq")).select(
        "chrom", F.col("chunk_no").cast("long").alias("chunk_no"), "seq")


def genome_slice(regions: DataFrame, genome: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Add ``genome_seq``, the genome text of [start, end), read from a chunked genome."""
    first, last = F.floor(F.col("start") / chunk), F.floor((F.col("end") - 1) / chunk)
    spans = regions.select("chrom", "start", "end").distinct().withColumn("chunk_no", F.explode(F.sequence(first, last)))
    base = F.col("chunk_no") * chunk
    lo, hi = F.greatest(F.col("start"), base) - base, F.least(F.col("end"), base + chunk) - base
    parts = (spans.join(genome, ["chrom", "chunk_no"])
             .select("chrom", "start", "end", F.struct("chunk_no", slice_seq("seq", lo, hi).alias("s")).alias("p"))
             .groupBy("chrom", "start", "end").agg(F.sort_array(F.collect_list("p")).alias("ps")))
    whole = parts.select("chrom", "start", "end",
                         F.array_join(F.transform("ps", lambda p: p["s"]), "").alias("genome_seq"))
    return regions.join(whole, ["chrom", "start", "end"], "left")


def validate_reference(aln: DataFrame, genome: DataFrame, ref_species: str, chunk: int = CHUNK) -> DataFrame:
    """Reference records with ``matches``: equal to the genome text, case ignored."""
    ref = aln.where(F.col("species") == ref_species)
    return genome_slice(ref, genome, chunk).withColumn(
        "matches", F.coalesce(F.upper("genome_seq") == F.upper("seq"), F.lit(False)))


def cut_blocks(blocks: DataFrame, features: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """Blocks cut to the features they meet: block_id, chrom, start, end, width (columns) and rows (species, text), one
    row per block and distinct stretch. Only coordinates meet in the interval join (``spans``: see ``meet_areas``), and of the
    rows of a block only species and texts are moved. Reference gaps between two bases of
    a stretch stay in it; a reference row shorter than the block's size is an error."""
    bare = blocks.select("block_id", "chrom", "start", "size", F.transform("rows", lambda r: F.struct(
        r["species"].alias("species"), r["text"].alias("text"))).alias("rows"))
    met = meet_areas(bare, features.select("chrom", "start", "end").where("start < end").distinct(), spans=spans)
    inside = F.transform("areas", lambda a: F.struct(F.greatest(a["start"], F.col("start")).alias("at"),
                                                     F.least(a["end"], F.col("start") + F.col("size")).alias("to")))
    ref = F.get("rows", F.lit(0))["text"]
    bases = F.filter(F.transform(F.split(ref, ""), lambda c, i: F.when(c != "-", i)), lambda i: i.isNotNull())
    wrong = F.raise_error(F.concat(F.lit("the reference row does not match the size of block "), F.col("block_id").cast("string")))
    at = (F.when(F.length(ref) == F.col("size"), F.sequence(F.lit(0), F.length(ref) - 1))
          .when(F.size(bases) == F.col("size"), bases).otherwise(wrong.cast("array<int>")))
    cut = met.select("block_id", "chrom", "start", first_per_species().alias("rows"), at.alias("cols"),
                     F.explode(F.array_distinct(inside)).alias("span"))
    first = F.get("cols", (F.col("span.at") - F.col("start")).cast("int"))
    width = F.get("cols", (F.col("span.to") - F.col("start") - 1).cast("int")) - first + 1
    rows = F.transform("rows", lambda r: F.struct(r["species"].alias("species"), F.substring(r["text"], F.col("first") + 1, F.col("width")).alias("text")))
    return (cut.select("block_id", "chrom", F.col("span.at").alias("start"), F.col("span.to").alias("end"), first.alias("first"),
                       width.alias("width"), "rows")
            .select("block_id", "chrom", "start", "end", "width", rows.alias("rows")))


def _closed_groups(widths: Sequence[int], size: int) -> tuple[list[int], list[int], list[int]]:
    """(reach, to, opened) of the pieces of a tile, for a group that is open at its start: columns up to the end of each piece
    that may close it, then the columns open at the tile's end and the groups opened, if the next group begins behind it.

    A first entry of 0 columns is for no open group. Nothing but the widths counts from where a group begins, so one pass from the
    last piece to the first tells this for all."""
    ends = list(accumulate(widths))
    n = len(ends)
    to, opened = [size] * (n + 1), [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        before = ends[i - 1] if i else 0
        j = bisect_left(ends, before + size, i)
        to[i], opened[i] = (ends[-1] - before, 1) if j == n else (to[j + 1], opened[j + 1] + 1)
    last = min(bisect_left(ends, size - 1) + 1, n)
    return [0, *ends[:last]], to[:last + 1], opened[:last + 1]


#: What orders the pieces of a chromosome. Pieces equal in all of it are one step.
_STEP = ("start", "end", "block_id", "content")


def group_numbers(pieces: DataFrame, min_size: int, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Numbers for consecutive pieces of a chromosome (chrom, start, end, block_id, content, width) that are put together until
    they hold ``min_size`` columns. What is left at the end of a chromosome is a group too. Pieces equal in place and
    content are one step and stay together.

    Where a group ends depends on where it began, so a running sum cannot tell. A tile is a function from the columns
    that are open at its start to those at its end, and what matters of them is the piece that closes the open group: a tile
    tells what follows each piece that may, one row per tile is followed along the chromosome, and tiles number their
    pieces from the state they are given. Tiles are array rows, many to a batch.

    Output, one row a tile: chrom, tile, group_no (one entry a piece of the tile, in order of ``_STEP``), and what may be shared with
    other tiles: ``open_first``, the number of the group that is open at the tile's start, and ``open_last``, that of the one open at its
    end, 0 where there is none."""
    order = list(_STEP)
    steps = pieces.groupBy("chrom", *order).agg(F.sum("width").alias("width"), F.count(F.lit(1)).alias("n"))
    tiles = written(steps.groupBy("chrom", position_tile("start", tile_width).alias("tile"))
                    .agg(F.sort_array(F.collect_list(F.struct(*order, "width", "n"))).alias("steps"))
                    .select("chrom", "tile", F.col("steps.width").alias("widths"), F.col("steps.n").alias("copies")), "tiles")

    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            widths = b.column("widths").to_pylist()
            found = list(zip(*(_closed_groups(w, min_size) for w in widths))) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column("chrom"), b.column("tile"), pa.array([sum(w) for w in widths], pa.int64()),
                 *(pa.array(list(f), pa.list_(pa.int64())) for f in found)], ["chrom", "tile", "total", "reach", "to", "opened"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chrom, rows = [], []
            for name, tiles_of in zip(b.column("chrom").to_pylist(), b.column("l").to_pylist()):
                state, group = 0, 0
                for t in tiles_of:
                    chrom.append(name)
                    rows.append((t["tile"], state, group))
                    k = 0 if state in (0, min_size) else bisect_left(t["reach"], min_size - state, 1)
                    if k == len(t["reach"]):
                        state += t["total"]
                    else:
                        state, group = t["to"][k], group + t["opened"][k]
            cols = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(chrom, pa.string()), *(pa.array(list(c), pa.int64()) for c in cols)], ["chrom", "tile", "state", "before"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for widths, copies, state, group in zip(*(b.column(c).to_pylist() for c in ("widths", "copies", "state", "before"))):
                numbers, first = [], 0 if state == 0 or state >= min_size else group
                for w, n in zip(widths, copies):
                    if state == 0 or state >= min_size:
                        state, group = 0, group + 1
                    state += w
                    numbers += [group] * n
                out.append((numbers, first, group if state < min_size else 0))
            cols = list(zip(*out)) or [[]] * 3
            kinds = (pa.list_(pa.int64()), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("chrom"), b.column("tile"), *(pa.array(list(c), t) for c, t in zip(cols, kinds))],
                                             ["chrom", "tile", "group_no", "open_first", "open_last"])

    lists = "reach array<long>, to array<long>, opened array<long>"
    tables = tiles.select("chrom", "tile", "widths").mapInArrow(tabulate, f"chrom string, tile long, total long, {lists}")
    lines = tables.groupBy("chrom").agg(F.sort_array(F.collect_list(F.struct("tile", "total", "reach", "to", "opened"))).alias("l"))
    entries = lines.mapInArrow(follow, "chrom string, tile long, state long, before long")
    return tiles.join(entries, ["chrom", "tile"]).select("chrom", "tile", "widths", "copies", "state", "before").mapInArrow(
        number, "chrom string, tile long, group_no array<long>, open_first long, open_last long")


def _numbered(pieces: DataFrame, min_size: int, tile_width: int) -> DataFrame:
    """``pieces``, which have ``content``, with what ``group_numbers`` tells of each. They move once, to the numbers of their tile, and
    stay dealt by chromosome and tile. ``pieces`` is read twice."""
    numbers = written(group_numbers(pieces, min_size, tile_width), "numbers")
    rest = [c for c in pieces.columns if c not in ("chrom", *_STEP)]
    tiles = pieces.groupBy("chrom", position_tile("start", tile_width).alias("tile")).agg(
        F.sort_array(F.collect_list(F.struct(*_STEP, *rest))).alias("p"))
    told = tiles.join(numbers, ["chrom", "tile"]).select("chrom", "tile", "open_first", "open_last", F.explode(F.arrays_zip("p", "group_no")).alias("x"))
    return told.select("chrom", "tile", *(F.col(f"x.p.{c}").alias(c) for c in (*_STEP, *rest)), F.col("x.group_no").alias("group_no"),
                       "open_first", "open_last")


def concat_groups(pieces: DataFrame, min_size: int, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Add ``group_no``, the number that ``group_numbers`` tells of each of ``pieces`` (chrom, start, end, block_id, width, rows)."""
    told = _numbered(pieces.withColumn("content", F.xxhash64("rows")), min_size, tile_width)
    return told.select(*pieces.columns, "group_no")


def concat_blocks(blocks: DataFrame, features: DataFrame, min_size: int = 200, tile_width: int = TILE_WIDTH,
                  spans: DataFrame | None = None) -> DataFrame:
    """Blocks cut to the features and put together, in order, until they hold ``min_size`` columns: chrom, group_no
    (from 1), start and end (of the first and last piece), n_pieces, width and rows (species, text). No piece is left out,
    however short. A species without a row in a piece has gaps there. A group holds ``min_size`` pieces at most.
    ``spans``: see ``meet_areas``.

    Pieces are written once. Numbers come from their coordinates; the texts of a tile then move once, to where its numbers go,
    and groups inside a tile are put together there. Only what a tile shares with the next one moves again."""
    pieces = written(cut_blocks(blocks, features, spans).withColumn("content", F.xxhash64("rows")), "pieces")
    each = _numbered(pieces, min_size, tile_width).withColumn("p", F.struct("start", "end", "block_id", "width", "rows"))
    shared = (F.col("group_no") == F.col("open_first")) | (F.col("group_no") == F.col("open_last"))
    parts = F.sort_array(F.collect_list("p")).alias("parts")
    groups = each.where(~shared).groupBy("chrom", "tile", "group_no").agg(parts).drop("tile").unionByName(
        each.where(shared).groupBy("chrom", "group_no").agg(parts))
    names = F.array_distinct(F.flatten(F.transform("parts", lambda p: F.transform(p["rows"], lambda r: r["species"]))))

    def text_of(name: Column) -> Column:
        def part(p: Column) -> Column:
            own = F.filter(p["rows"], lambda r: r["species"] == name)
            return F.coalesce(F.get(F.transform(own, lambda r: r["text"]), F.lit(0)), F.repeat(F.lit("-"), p["width"]))

        return F.array_join(F.transform("parts", part), "")

    rows = F.transform(names, lambda n: F.struct(n.alias("species"), text_of(n).alias("text")))
    return groups.select("chrom", "group_no", F.get("parts", F.lit(0))["start"].alias("start"),
                         F.array_max(F.transform("parts", lambda p: p["end"])).alias("end"), F.size("parts").alias("n_pieces"),
                         F.aggregate("parts", F.lit(0), lambda a, p: a + p["width"]).alias("width"), rows.alias("rows"))
