"""Site patterns: column compression, missing-data filter with summary, four-fold sites."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basetide.functions.sequences import count_char
from basetide.operators.alignment import char_matrix, meet_areas
from basetide.operators.intervals import merge_intervals
from basetide.plans.lineage import cut, written
from basetide.plans.ordered import TILE_WIDTH, Scan, ordered_scan, position_tile

MISSING = "*"


def species_texts(species: Sequence[str]) -> Column:
    """The first text of each species in a block; ``*`` over its whole width where it has no row."""
    ref = F.get("rows", F.lit(0))["text"]

    def text_of(s):
        own = F.filter("rows", lambda r: r["species"] == s)
        return F.coalesce(F.try_element_at(F.transform(own, lambda r: r["text"]), F.lit(1)),
                          F.repeat(F.lit(MISSING), F.length(ref)))

    return F.transform(F.array(*[F.lit(s) for s in species]), text_of)


def block_columns(blocks: DataFrame, species: Sequence[str]) -> DataFrame:
    """(pattern, n) per batch of blocks: alignment columns in the given species order, ``*`` where a
    species has no row. Columns are counted inside the task, so only distinct ones are shuffled."""
    return (blocks.where(F.size("rows") > 0).select(species_texts(species).alias("texts"))
            .mapInPandas(_count_columns, "pattern string, n long"))


def _count_columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        # every block has one text per species, so the texts of a species can be laid end to end
        cells = char_matrix(["".join(texts) for texts in zip(*pdf["texts"])]).astype("<u4")
        if cells.size:
            columns = np.ascontiguousarray(cells.T).view(f"<U{cells.shape[0]}").ravel()
            counts = pd.Series(columns.astype(object)).value_counts()
            yield pd.DataFrame({"pattern": counts.index, "n": counts.to_numpy(dtype=np.int64)})


def site_patterns(columns: DataFrame) -> DataFrame:
    """Distinct patterns with counts and a running ``idx``.

    Input has ``pattern`` and optionally ``n`` (so the union of several pattern tables works too).
    The order is that of md5(pattern): its four leading hex digits give 65,536 evenly filled tiles
    for the numbering, whatever the patterns look like.
    """
    n = F.sum("n") if "n" in columns.columns else F.count(F.lit(1))
    # the numbering reads the counts twice, the alignment only once
    counts = cut(columns.groupBy("pattern").agg(n.cast("long").alias("n"))).withColumn("_h", F.md5("pattern"))
    tiled = counts.withColumn("_tile", F.substring("_h", 1, 4)).withColumn("_one", F.lit(1).cast("long"))
    out = ordered_scan(tiled, [], ["_h", "pattern"], "_tile", [Scan("idx", "sum", "_one", inclusive=False)])
    return out.select("idx", "pattern", "n")


def pattern_header(patterns: DataFrame) -> DataFrame:
    """NSEQS, LENGTH and NTUPLES of a pattern table as (key, value) rows."""
    agg = patterns.agg(F.max(F.length("pattern")).alias("NSEQS"), F.sum("n").alias("LENGTH"),
                       F.count(F.lit(1)).alias("NTUPLES"))
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in ("NSEQS", "LENGTH", "NTUPLES")
    ])).alias("h")).select("h.key", "h.value")


def mark_patterns(patterns: DataFrame, nseq: int, threshold: float, per_site: bool = False) -> DataFrame:
    """Add ``missing`` and ``kept``. The limit is round-half-even(nseq * threshold); by default the
    missing count is multiplied by the site count before it is compared, ``per_site`` compares the
    missing species of one site."""
    missing = count_char("pattern", MISSING)
    weighted = (missing * F.col("n")).cast("long")
    limit = round(nseq * threshold)
    return patterns.withColumn("missing", weighted).withColumn("kept", (missing if per_site else weighted) <= limit)


def filter_patterns(patterns: DataFrame, nseq: int, threshold: float, per_site: bool = False,
                    check: bool = True, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Kept patterns, renumbered in idx order. With ``check``, fails when a species is missing in
    every kept pattern."""
    marked = mark_patterns(patterns, nseq, threshold, per_site)
    if check and lost_species(marked, nseq).head(1):
        raise ValueError("a species has no data left after filtering")
    kept = (marked.where("kept").withColumnRenamed("idx", "_old").withColumn("_one", F.lit(1).cast("long"))
            .withColumn("_tile", position_tile("_old", tile_width)))
    out = ordered_scan(kept, [], "_old", "_tile", [Scan("idx", "sum", "_one", inclusive=False)])
    return out.select("idx", "pattern", "n")


def species_presence(marked: DataFrame, nseq: int) -> DataFrame:
    """Per species (position in the pattern): kept patterns that have data for it."""
    kept = marked.where("kept")
    flags = [F.sum((F.substring("pattern", i + 1, 1) != MISSING).cast("long")).alias(f"s{i}") for i in range(nseq)]
    wide = kept.agg(*flags)
    return (wide.select(F.posexplode(F.array(*[F.coalesce(f"s{i}", F.lit(0)) for i in range(nseq)])))
            .toDF("species_no", "n_present"))


def lost_species(marked: DataFrame, nseq: int) -> DataFrame:
    return species_presence(marked, nseq).where(F.col("n_present") == 0)


def pattern_summary(patterns: DataFrame, nseq: int, threshold: float, per_site: bool = False) -> DataFrame:
    """Pre- and post-filter statistics as (var, filter_cat, value) rows, from one aggregate."""
    marked = mark_patterns(patterns, nseq, threshold, per_site)
    cols = []
    for cat, on in (("pre", F.lit(True)), ("post", F.col("kept"))):
        n, miss = F.when(on, F.col("n")), F.when(on, F.col("missing"))
        cols += [F.coalesce(F.sum(n), F.lit(0)).alias(f"{cat}_len"), F.count(n).alias(f"{cat}_sites"),
                 F.coalesce(F.max(n), F.lit(0)).alias(f"{cat}_max"),
                 F.count(F.when(n == 1, 1)).alias(f"{cat}_single"),
                 F.coalesce(F.sum(miss), F.lit(0)).alias(f"{cat}_missing")]
    present = [F.max((F.col("kept") & (F.substring("pattern", i + 1, 1) != MISSING)).cast("int")).alias(f"s{i}")
               for i in range(nseq)]
    one = marked.agg(*cols, *present)
    seqs = {"pre": F.lit(float(nseq)),
            "post": sum((F.coalesce(F.col(f"s{i}"), F.lit(0)) for i in range(nseq)), F.lit(0)).cast("double")}
    rows = []
    for cat in ("pre", "post"):
        length, sites, missing = (F.col(f"{cat}_{k}") for k in ("len", "sites", "missing"))
        stats = {"num.seqs": seqs[cat], "aln.len": length, "num.sites": sites, "avg.site.count": length / sites,
                 "max.site.count": F.col(f"{cat}_max"), "num.singletons": F.col(f"{cat}_single"),
                 "total.missing.cols": missing, "avg.missing.per.site": missing / length}
        rows += [F.struct(F.lit(k).alias("var"), F.lit(f"{cat}.filter").alias("filter_cat"),
                          v.cast("double").alias("value")) for k, v in stats.items()]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# Fixed values of the standard genetic code: first two codon bases whose third base is free.
FOURFOLD_PREFIXES = ("AC", "CC", "CG", "CT", "GC", "GG", "GT", "TC")
COMPLEMENT = {"A": "T", "C": "G", "G": "C", "T": "A"}


def _transcripts(gff: DataFrame) -> DataFrame:
    """CDS rows with 0-based ends, phase and the transcript they belong to, one row per transcript they name
    (``transcript_id`` or the comma-separated ``Parent``); a row that names none is a transcript of its own."""
    place = ["seqid", "strand", "start", "end"]
    phase = F.coalesce(F.col("phase").try_cast("int"), F.lit(0))
    cds = gff.where(F.col("type") == "CDS").withColumn("_ph", phase)
    own = F.concat_ws(":", *place, "_ph")
    if "attributes" in gff.columns:
        found = [F.regexp_extract(F.coalesce("attributes", F.lit("")), p, 1)
                 for p in (r'transcript_id[ =]"?([^";]+)', r"(?:^|;)\s*Parent=([^;]+)")]
        own = F.coalesce(*[F.nullif(x, F.lit("")) for x in found], own)
    return cds.select(
        F.col("seqid").alias("chrom"), (F.coalesce("strand", F.lit("+")) != "-").alias("ahead"), (F.col("start") - 1).alias("s"),
        F.col("end").alias("e"), F.col("_ph").alias("ph"), F.explode(F.split(own, ",")).alias("transcript")).distinct()


def _placed_features(gff: DataFrame) -> DataFrame:
    """CDS features with their place in the reading of their transcript. The window runs over the features of one transcript."""
    n = F.col("e") - F.col("s")
    w = Window.partitionBy("chrom", "ahead", "transcript").orderBy(F.when(F.col("ahead"), F.col("s")).otherwise(-F.col("e")), n)
    part = Window.partitionBy("chrom", "ahead", "transcript", "run").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    fits = F.col("ph") == F.pmod(F.lag(F.col("ph") - n).over(w), F.lit(3))
    return (_transcripts(gff).withColumn("no", F.row_number().over(w))
            .withColumn("_new", F.when(F.coalesce(fits, F.lit(False)), 0).otherwise(1))
            .withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("before", F.coalesce(F.sum(n).over(part), F.lit(0)))
            .withColumn("skip", F.coalesce(F.first("ph").over(part), F.col("ph"))))


def _base_at(offset: Column) -> Column:
    return F.when(F.col("ahead"), F.col("s") + offset).otherwise(F.col("e") - 1 - offset)


def _whole_codons() -> Column:
    return F.greatest(F.lit(0), F.floor((F.col("e") - F.col("s") - F.col("ph")) / 3))


def _split_codons(placed: DataFrame) -> DataFrame:
    """(chrom, ahead, b1, b2, b3) of the codons put together from the bases left at the ends of features."""
    n, whole = F.col("e") - F.col("s"), _whole_codons()
    head = F.filter(F.array(F.lit(0), F.lit(1)), lambda i: i < F.least("ph", n))
    tail = F.filter(F.transform(F.array(F.lit(0), F.lit(1)), lambda i: F.col("ph") + 3 * whole + i), lambda i: i < n)
    rest = placed.withColumn("o", F.explode(F.concat(F.transform(head, lambda i: i.cast("long")), tail)))
    at = F.col("before") + F.col("o") - F.col("skip")
    return (rest.select("chrom", "ahead", "transcript", "run", F.floor(at / 3).alias("codon"), F.pmod(at, F.lit(3)).alias("place"),
                        _base_at(F.col("o")).alias("pos"))
            .groupBy("chrom", "ahead", "transcript", "run", "codon")
            .agg(*[F.max(F.when(F.col("place") == i, F.col("pos"))).alias(f"b{i + 1}") for i in range(3)])
            .where(F.col("b1").isNotNull() & F.col("b2").isNotNull() & F.col("b3").isNotNull()).select("chrom", "ahead", "b1", "b2", "b3"))


def codon_positions(gff: DataFrame) -> DataFrame:
    """CDS features (1-based inclusive, with strand and phase) -> one row per complete codon:
    chrom, strand and the positions b1, b2, b3 (0-based) of its bases in reading order.

    Codons inside one feature come from its phase alone. The bases left at the ends of features are put together
    along the transcript; where a phase does not fit the feature before it, reading starts anew and the
    bases before the phase have no codon."""
    placed = _placed_features(gff)
    whole, first = _whole_codons(), F.col("ph") + 3 * F.col("k")
    inside = (placed.where(whole > 0).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)))
              .select("chrom", "ahead", _base_at(first).alias("b1"), _base_at(first + 1).alias("b2"), _base_at(first + 2).alias("b3")))
    return (inside.unionByName(_split_codons(placed)).distinct()
            .select("chrom", F.when(F.col("ahead"), "+").otherwise("-").alias("strand"), "b1", "b2", "b3"))


_BASES = "ACGT"
#: By code point: the number of a base, 4 for all others.
_NUMBER = np.array([_BASES.find(chr(c).upper()) % 5 for c in range(128)])
_OPPOSITE = np.array([_BASES.find(COMPLEMENT[b]) for b in _BASES] + [4])
_FREE = np.array([[f"{a}{b}" in FOURFOLD_PREFIXES for b in f"{_BASES}-"] for a in f"{_BASES}-"])
#: Phases that are no phase: a codon of given places, a stretch where blocks overlap each other.
_PLACES, _SHARED = -1, -2


def _codons_touched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The codons that have a base in a block. What is whole inside a block that shares no base with another one is decided here
    (``hit``, only with the place of the third base and its column). Of all others a row tells what the block knows of them: the letters of the
    first two bases and the column of the third. The first text of a block is the reference."""
    names = ["hit", "ahead", "b1", "b2", "b3", "x0", "x1", "pattern"]
    for pdf in batches:
        chroms, sizes, out = [], [], []
        for chrom, start, size, texts, s, e, ahead, ph, b1, b2, b3 in pdf.itertuples(index=False, name=None):
            cells = char_matrix(list(texts)).astype("<u4")
            at = np.arange(size) if cells.shape[1] == size else np.flatnonzero(cells[0] != ord("-"))
            if len(at) != size:
                raise ValueError(f"the reference row does not match the size of the block at {chrom}:{start}")
            ref = cells[0, at]
            number = np.where(ref < 128, _NUMBER[np.minimum(ref, 127)], 4)
            columns = np.ascontiguousarray(cells[1:, at].T).view(f"<U{len(cells) - 1}").ravel()
            alone = not (ph == _SHARED).any()
            for i in range(len(s)):
                if ph[i] == _SHARED:
                    continue
                if ph[i] == _PLACES:
                    codon = [np.array([b[i]]) for b in (b1, b2, b3)]
                else:
                    lo, hi = max(s[i], start), min(e[i], start + size) - 1
                    near, far = (lo - s[i], hi - s[i]) if ahead[i] else (e[i] - 1 - hi, e[i] - 1 - lo)
                    k = np.arange(max((near - ph[i]) // 3, 0), min((far - ph[i]) // 3, (e[i] - s[i] - ph[i]) // 3 - 1) + 1)
                    first = s[i] + ph[i] + 3 * k if ahead[i] else e[i] - 1 - ph[i] - 3 * k
                    codon = [first, first + 1, first + 2] if ahead[i] else [first, first - 1, first - 2]
                here = [pos - start for pos in codon]
                inside = [(x >= 0) & (x < size) for x in here]
                whole = inside[0] & inside[1] & inside[2] if alone else np.zeros(len(here[0]), bool)
                if whole.any():
                    one, two = (number[x[whole]] for x in here[:2])
                    free = _FREE[one, two] if ahead[i] else _FREE[_OPPOSITE[one], _OPPOSITE[two]]
                    n = int(free.sum())
                    if n:
                        none = np.zeros(n, np.int64)
                        chroms.append(chrom)
                        sizes.append(n)
                        out.append([np.ones(n, bool), np.ones(n, bool), none, none, codon[2][whole][free], np.full(n, None, object),
                                    np.full(n, None, object), columns[here[2][whole][free]].astype(object)])
                rest = ~whole
                n = int(rest.sum())
                if n:
                    known = []
                    for x, there, values in zip(here, inside, (ref.view("<U1"), ref.view("<U1"), columns)):
                        value = np.full(n, None, object)
                        value[there[rest]] = values[x[rest & there]]
                        known.append(value)
                    chroms.append(chrom)
                    sizes.append(n)
                    out.append([np.zeros(n, bool), np.full(n, bool(ahead[i])), *(c[rest] for c in codon), *known])
        if out:
            cols = [np.concatenate(c) for c in zip(*out)]
            yield pd.DataFrame({"chrom": np.repeat(np.array(chroms, object), sizes), **dict(zip(names, cols))})


def fourfold_columns(blocks: DataFrame, gff: DataFrame, species: Sequence[str], spans: DataFrame | None = None) -> DataFrame:
    """Alignment columns at the third position of codons whose first two reference bases leave the
    third one free: (chrom, pos, pattern). The three bases may lie in different blocks and features; a codon
    with a base that no block covers is left out.

    Blocks meet features by coordinates (``meet_areas``). A codon inside a block that overlaps no other one is decided in its task, and
    goes on only where it counts; of the others, at the borders of blocks, each block tells what it knows, one row a codon. No row of a
    single base is made or joined. Rows move once, to the place of the third base. Only codons that are split over features are laid
    out in front of the join. ``spans`` (chrom, start, size) has a row for every block, where an index knows them."""
    kinds = {"start": "long", "end": "long", "ahead": "boolean", "ph": "int", "b1": "long", "b2": "long", "b3": "long"}
    placed = _placed_features(gff)
    none = F.lit(-1).cast("long")
    blocks = blocks.where(F.size("rows") > 0)
    spans = written((blocks if spans is None else spans).select("chrom", "start", "size"), "block-spans")
    shared = (merge_intervals(spans.where("size > 0").select("chrom", "start", (F.col("start") + F.col("size")).alias("end")), gap=-1, count=True)
              .where("n_merged > 1"))
    features = placed.where(_whole_codons() > 0).select(
        "chrom", F.col("s").alias("start"), F.col("e").alias("end"), "ahead", "ph", none.alias("b1"), none.alias("b2"), none.alias("b3"))
    split = _split_codons(placed).withColumn("start", F.explode(F.array("b1", "b2", "b3"))).withColumn("end", F.col("start") + 1)
    marks = shared.select("chrom", "start", "end", F.lit(True).alias("ahead"), F.lit(_SHARED).alias("ph"), none.alias("b1"), none.alias("b2"), none.alias("b3"))
    areas = features.unionByName(split.withColumn("ph", F.lit(_PLACES))).unionByName(marks)
    areas = areas.select("chrom", *[F.col(c).cast(t) for c, t in kinds.items()]).distinct()
    ref = F.get("rows", F.lit(0))["text"]
    bare = blocks.select("chrom", "start", "size", F.concat(F.array(ref), species_texts(species)).alias("texts"))
    told = meet_areas(bare, areas, spans=spans).select("chrom", "start", "size", "texts", *[F.col("areas")[c].alias(f"a_{c}") for c in kinds]).mapInPandas(
        _codons_touched, "chrom string, hit boolean, ahead boolean, b1 long, b2 long, b3 long, x0 string, x1 string, pattern string")

    codon = Window.partitionBy("chrom", "b3", "hit", "ahead", "b1", "b2")

    def read(letter: str) -> Column:
        base = F.upper(letter)
        return F.max(F.when(F.col("ahead"), base).otherwise(F.translate(base, "".join(COMPLEMENT), "".join(COMPLEMENT.values())))).over(codon)

    met = told.repartition("chrom", "b3").withColumn("first", read("x0")).withColumn("second", read("x1"))
    hits = met.where(F.col("pattern").isNotNull() & (F.col("hit") | F.concat("first", "second").isin(*FOURFOLD_PREFIXES)))
    return hits.select("chrom", F.col("b3").alias("pos"), "pattern").distinct()
