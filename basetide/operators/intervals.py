"""Half-open intervals: windows, overlap joins, counts, merging, run packing and binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.plans.ordered import TILE_WIDTH, Scan, ordered_scan, placed, position_tile
from basetide.plans.skew import HOT_ROWS, grid_salt

_STRIDE = 4096


def _stepped(first: Column, last: Column, step: int = 1) -> Column:
    """first, first+step .. last; an empty array when last < first."""
    return F.when(last >= first, F.sequence(first, last, F.lit(step).cast("long"))).otherwise(
        F.array().cast("array<bigint>"))


def _explode_range(df: DataFrame, first: Column, last: Column, out: str) -> DataFrame:
    """One row per integer in [first, last], in two steps so that no row builds an array of more
    than a few thousand entries per step and wide ranges spread before the second step."""
    block = df.withColumn("_lo", first.cast("long")).withColumn("_hi", last.cast("long"))
    block = block.withColumn("_blk", F.explode(F.expr(f"sequence(_lo div {_STRIDE}, _hi div {_STRIDE})")))
    inner = F.expr(f"sequence(greatest(_lo, _blk * {_STRIDE}), least(_hi, _blk * {_STRIDE} + {_STRIDE - 1}))")
    return block.withColumn(out, F.explode(inner)).drop("_lo", "_hi", "_blk")


def make_windows(chromes: DataFrame, width: int) -> DataFrame:
    """Windows of a fixed width over every chromosome, the last one cut at the chromosome end."""
    live = chromes.where(F.col("length") > 0).select("chrom", "length")
    out = _explode_range(live, F.lit(0), F.floor((F.col("length") - 1) / width), "window_no")
    start = F.col("window_no") * F.lit(width)
    return out.select("chrom", start.alias("start"), F.least(start + width, F.col("length")).alias("end"), "window_no")


def number_windows(windows: DataFrame, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Number windows from 0 within a chromosome, in start order, with a two-digit label."""
    w = windows.withColumn("_tile", position_tile("start", tile_width)).withColumn("_one", F.lit(1).cast("long"))
    out = ordered_scan(w, ["chrom"], ["start", "end"], "_tile", [Scan("win_no", "sum", "_one", inclusive=False)])
    label = F.when(F.col("win_no") < 100, F.lpad(F.col("win_no").cast("string"), 2, "0")).otherwise(
        F.col("win_no").cast("string"))
    return out.drop("_tile", "_one").withColumn("win_label", label)


def chrom_extents(chromes: DataFrame, names: Sequence[str] | None = None, end_offset: int = 1) -> DataFrame:
    """(chrom, 0, length - end_offset) for the listed chromosomes."""
    kept = chromes if names is None else chromes.where(F.col("chrom").isin(*names))
    return kept.select("chrom", F.lit(0).cast("long").alias("start"), (F.col("length") - end_offset).alias("end"))


def point_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Overlap join of 1-bp sites: overlap means equal (chrom, start), so it is an equi-join; AQE
    splits a hot position. Output: a's columns, b's as ``b_*``, and ``overlap``."""
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    on = (F.col("chrom") == F.col("b_chrom")) & (F.col("start") == F.col("b_start"))
    return a.join(right, on).withColumn("overlap", F.least("end", "b_end") - F.greatest("start", "b_start"))


#: Each length class has bins this many times as wide as the one before it.
CLASS_STEP = 4


def length_class(length: Column, base: int) -> Column:
    """Number of the narrowest class whose bins, base * CLASS_STEP ** class wide, are as long as an interval."""
    over = F.greatest(F.ceil(length / base), F.lit(1))
    guess = F.greatest(F.ceil(F.log(float(CLASS_STEP), over.cast("double"))).cast("int"), F.lit(0))
    # the logarithm may be off by one at powers
    enough = lambda c: F.pow(F.lit(float(CLASS_STEP)), c) >= over
    return F.when(~enough(guess), guess + 1).when((guess > 0) & enough(guess - 1), guess - 1).otherwise(guess)


def overlap_join(a: DataFrame, b: DataFrame, bin_width: int | None = None,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """All overlapping pairs (a.start < b.end and b.start < a.end) with the overlap length.

    Intervals fall into classes by length, and the bins of a class are as wide as its longest interval, so each lies on
    two bins of its class at most. A pair meets on the bins of the longer one's class: one join takes b there with a on all
    classes from its own up that b has, the other one a with b on the classes above its own. So an interval is laid out on
    two bins for every class that occurs, whatever the mix of lengths, and a pair is kept only in the bin that holds the
    later start, so no distinct is needed. The narrowest bins are ``bin_width`` wide, by default the median length.
    Crowded bins are split into a grid of cells. Output: a's columns, b's as ``b_*``, and ``overlap``.
    """
    lengths = a.select(F.col("end") - F.col("start")).union(b.select(F.col("end") - F.col("start"))).toDF("len")
    if bin_width is None:
        bin_width = max(1, int(lengths.agg(F.percentile_approx("len", 0.5, 1000)).first()[0] or 1))

    def classed(df: DataFrame, prefix: str, out: str) -> DataFrame:
        s, e = F.col(f"{prefix}start"), F.col(f"{prefix}end")
        return df.where(s.isNotNull() & e.isNotNull()).withColumn(out, length_class(F.greatest(e - s, F.lit(1)), bin_width))

    left = classed(a, "", "_ca")
    right = classed(b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]), "b_", "_cb")
    # classes are few: four times as long each
    found = [sorted(r[0] for r in df.select(c).distinct().collect()) for df, c in ((left, "_ca"), (right, "_cb"))]
    latest = F.greatest("start", "b_start")

    def on_bins(df: DataFrame, prefix: str, own: str, classes: Column | None) -> DataFrame:
        level = df.withColumn("_class", F.col(own) if classes is None else F.explode(classes))
        width = (F.lit(float(bin_width)) * F.pow(F.lit(float(CLASS_STEP)), F.col("_class"))).cast("long")
        s, e = F.col(f"{prefix}start"), F.col(f"{prefix}end")
        out = level.withColumn("_width", width).withColumn("_bin", F.explode(F.sequence(
            F.floor(s / F.col("_width")), F.floor((F.greatest(e, s + 1) - 1) / F.col("_width")))))
        return out.withColumn("_chrom", F.col(f"{prefix}chrom")).drop(own)

    def met(one: DataFrame, two: DataFrame) -> DataFrame:
        one, two = grid_salt(one, two.drop("_width"), ["_chrom", "_class", "_bin"], hot_rows)
        pairs = one.join(two, ["_chrom", "_class", "_bin", "_ls", "_rs"]).where(
            (F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end")) & (F.col("_bin") == F.floor(latest / F.col("_width"))))
        return pairs.select(*a.columns, *[f"b_{c}" for c in b.columns], (F.least("end", "b_end") - latest).alias("overlap"))

    def above(own: str, classes: list[int], strictly: bool) -> Column:
        every = F.array(*[F.lit(c) for c in classes]).cast("array<int>")
        return F.filter(every, lambda c: (c > F.col(own)) if strictly else (c >= F.col(own)))

    pairs = met(on_bins(left, "", "_ca", above("_ca", found[1], False)), on_bins(right, "b_", "_cb", None))
    if found[0] and found[1] and max(found[0]) > min(found[1]):
        pairs = pairs.unionByName(met(on_bins(left, "", "_ca", None), on_bins(right, "b_", "_cb", above("_cb", found[0], True))))
    return pairs


def overlap_count(a: DataFrame, b: DataFrame, out: str = "n", tile_width: int = TILE_WIDTH) -> DataFrame:
    """Every row of ``a`` with the number of rows of ``b`` it overlaps, 0 included.

    No pair is ever formed: the count is (b starts before a's end) - (b ends at or before a's
    start), two running totals over distinct positions. Intervals must not be empty.
    """
    edges = F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("s"), F.lit(0).alias("e")),
                              F.struct(F.col("end").alias("pos"), F.lit(0).alias("s"), F.lit(1).alias("e"))))
    asked = F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(0).alias("s"), F.lit(0).alias("e")),
                              F.struct(F.col("end").alias("pos"), F.lit(0).alias("s"), F.lit(0).alias("e"))))
    points = (placed(b, "chrom").select("chrom", edges.alias("x")).union(placed(a, "chrom").select("chrom", asked.alias("x")))
              .where(F.col("x.pos").isNotNull())
              .groupBy("chrom", F.col("x.pos").alias("pos"))
              .agg(F.sum("x.s").alias("s"), F.sum("x.e").alias("e"))
              .withColumn("_tile", position_tile("pos", tile_width)))
    cum = ordered_scan(points, ["chrom"], "pos", "_tile",
                       [Scan("_started", "sum", "s", inclusive=False), Scan("_ended", "sum", "e")])
    at_end = cum.select("chrom", F.col("pos").alias("end"), "_started")
    at_start = cum.select("chrom", F.col("pos").alias("start"), "_ended")
    counted = a.join(at_end, ["chrom", "end"], "left").join(at_start, ["chrom", "start"], "left")
    return counted.select(*a.columns, (F.col("_started") - F.col("_ended")).cast("long").alias(out))


def window_counts(windows: DataFrame, sites: DataFrame, width: int, out: str = "n") -> DataFrame:
    """``overlap_count`` for fixed-width windows and 1-bp sites: one map-side combined count per
    window and one left join."""
    counts = (sites.groupBy("chrom", F.floor(F.col("start") / width).alias("window_no"))
              .agg(F.count(F.lit(1)).alias(out)))
    return (windows.join(counts, ["chrom", "window_no"], "left")
            .select("chrom", "start", "end", "window_no", F.coalesce(out, F.lit(0)).cast("long").alias(out)))


def indexed_length(df: DataFrame, chromes: DataFrame) -> DataFrame:
    """``df`` with the ``length`` of its chromosome. A chromosome that the index lacks is an error and not a
    reason to lose rows."""
    known = chromes.select("chrom", "length").where(F.col("length").isNotNull())
    missing = F.raise_error(F.concat(F.lit("chromosome is not in the index: "), F.coalesce("chrom", F.lit("null"))))
    return df.join(known, "chrom", "left").withColumn("length", F.coalesce("length", missing.cast("long")))


def occupied_windows(sites: DataFrame, chromes: DataFrame, width: int, keys: Sequence[str] = (),
                     out: str = "n") -> DataFrame:
    """Windows that hold at least one 1-bp site, with the count: no window skeleton is laid out."""
    counts = (sites.groupBy(*keys, "chrom", F.floor(F.col("start") / width).alias("window_no"))
              .agg(F.count(F.lit(1)).alias(out)))
    start = F.col("window_no") * F.lit(width)
    return (indexed_length(counts, chromes)
            .select(*keys, "chrom", start.alias("start"), F.least(start + width, "length").alias("end"), "window_no", out))


def windows_by_count(counted: DataFrame, n: str = "n") -> DataFrame:
    """How many windows hold 0, 1, 2 ... sites."""
    return counted.groupBy(F.col(n).alias("n_sites")).agg(F.count(F.lit(1)).alias("n_windows"))


def merge_intervals(df: DataFrame, gap: int = 0, keys: Sequence[str] = ("chrom",), sums: Sequence[str] = (),
                    count: bool = False, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Merge intervals whose distance to the furthest end so far is at most ``gap`` (bookended ones
    merge at 0). Output: keys, start, end, the totals of the ``sums`` columns and, with ``count``,
    the number of intervals merged (``n_merged``). Without extra columns all branches of the two
    scans share the same two shuffles."""
    keys, sums = list(keys), list(sums)
    if count:
        df, sums = df.withColumn("n_merged", F.lit(1).cast("long")), [*sums, "n_merged"]
    rows = placed(df, *keys, "start").groupBy(*keys, "start").agg(F.max("end").alias("end"), *[F.sum(c).alias(c) for c in sums])
    rows = rows.withColumn("_tile", position_tile("start", tile_width))
    reach = ordered_scan(rows, keys, "start", "_tile", [Scan("_reach", "max", "end", inclusive=False)])
    opens = F.col("_reach").isNull() | (F.col("start") - F.col("_reach") > gap)
    islands = ordered_scan(reach.withColumn("_open", F.when(opens, F.col("start"))), keys, "start", "_tile",
                           [Scan("_island", "max", "_open")])
    return (islands.groupBy(*keys, "_island")
            .agg(F.max("end").alias("end"), *[F.sum(c).alias(c) for c in sums])
            .select(*keys, F.col("_island").alias("start"), "end", *sums))


def pack_runs(df: DataFrame, value: str, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Join touching rows of a track (end = next start) that carry the same value."""
    rows = placed(df.select("chrom", "start", "end", value), "chrom", "start").withColumn("_tile", position_tile("start", tile_width))
    rows = rows.withColumn("_cell", F.struct("end", value))
    prev = ordered_scan(rows, ["chrom"], "start", "_tile", [Scan("_prev", "last", "_cell", inclusive=False)])
    joined = (F.col("_prev.end") == F.col("start")) & F.col(f"_prev.{value}").eqNullSafe(F.col(value))
    opened = prev.withColumn("_open", F.when(~F.coalesce(joined, F.lit(False)), F.col("start")))
    runs = ordered_scan(opened, ["chrom"], "start", "_tile", [Scan("_run", "max", "_open")])
    return (runs.groupBy("chrom", "_run", value).agg(F.max("end").alias("end"))
            .select("chrom", F.col("_run").alias("start"), "end", value))


def expand_runs(df: DataFrame) -> DataFrame:
    """One row per base of every interval; the other columns are repeated."""
    out = _explode_range(df, F.col("start"), F.col("end") - 1, "pos")
    rest = [c for c in df.columns if c not in ("start", "end")]
    return out.select(*rest, F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))


def binned_counts(df: DataFrame, chromes: DataFrame, width: int) -> DataFrame:
    """Counts per 1-based bin of ``start``, with empty bins filled with 0 up to the chromosome end."""
    counts = (df.groupBy("chrom", (F.floor(F.col("start") / width) + 1).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    skeleton = make_windows(chromes, width).select("chrom", (F.col("window_no") + 1).alias("bin"))
    return (skeleton.join(counts, ["chrom", "bin"], "left")
            .select("chrom", "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def histogram(df: DataFrame, col: str, width: float, keys: Sequence[str] = ()) -> DataFrame:
    """Fixed-width histogram: bin number and lower edge; rows with NULL fall out."""
    no = F.floor(F.col(col) / F.lit(width)).cast("long")
    return (df.where(F.col(col).isNotNull()).groupBy(*keys, no.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")).withColumn("bin_start", F.col("bin") * F.lit(width)))


def histogram_bins(df: DataFrame, col: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Histogram of ``bins`` equal bins from the smallest to the largest value, which lies in the last bin; rows with NULL
    fall out. The range is that of the whole table for every key. Equal values make one bin, number 0."""
    lo, hi = df.agg(F.min(col)).scalar(), df.agg(F.max(col)).scalar()
    no = F.when(hi > lo, F.least(F.floor((F.col(col) - lo) * bins / (hi - lo)).cast("long"), F.lit(bins - 1).cast("long"))).otherwise(0)
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("bin_start", lo + F.col("bin") * (hi - lo) / bins)


def length_filter(df: DataFrame, min_len: int = 20, max_len: int = 10000) -> DataFrame:
    """Label elements: ``short`` when length <= min_len, ``long`` when >= max_len, else ``kept``."""
    length = F.col("end") - F.col("start")
    label = F.when(length <= min_len, "short").when(length >= max_len, "long").otherwise("kept")
    return df.withColumn("length", length).withColumn("length_class", label)


def with_density(df: DataFrame, n: str = "num_conserved") -> DataFrame:
    length = F.col("end") - F.col("start")
    return df.withColumn("length", length).withColumn("density", F.col(n) / length)


def element_totals(elements: DataFrame, *keys: str) -> DataFrame:
    """Elements and covered bases per chromosome and cutoff (or whatever keys are named)."""
    return elements.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_elements"),
                                       F.sum(F.col("end") - F.col("start")).alias("bases"))
