"""Scored sites: classification, Benjamini-Hochberg adjustment, filters and per-key counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.plans.ordered import Scan, ordered_scan, placed, value_tiles
from basetide.plans.skew import lookup_join


def classify_scores(df: DataFrame, score_col: str = "score") -> DataFrame:
    """Score -> status (0 conserved, 1 neutral, 2 accelerated) and raw p = 10^-|score|."""
    s = F.col(score_col)
    status = F.when(s > 0, 0).when(s < 0, 2).when(s == 0, 1).cast("tinyint")
    return df.withColumn("status", status).withColumn("p_value", F.pow(F.lit(10.0), -F.abs(s)))


def bh_adjust(df: DataFrame, p_col: str = "p_value", scope: str | None = None, alpha: float = 0.05,
              tiles: int | None = None) -> DataFrame:
    """Benjamini-Hochberg: adds ``p_adj`` and ``sig``; genome-wide, or per value of ``scope``.

    Works on the histogram of distinct p-values, cut into value tiles, so neither the rank nor the
    reverse running minimum needs a one-task window. Every tie gets N/r_max * p, which is what the
    reverse minimum gives it. Rows with a NULL p keep NULL results.
    """
    keys = [scope] if scope else []
    present = placed(df, *keys, p_col).select(*keys, p_col)
    tiled = value_tiles(present, p_col, tiles=tiles)
    hist = tiled.groupBy(*keys, "_tile", p_col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = ordered_scan(hist, keys, p_col, "_tile", [Scan("_rank", "sum", "_n"), Scan("_total", "total", "_n")])
    ranked = ranked.withColumn("_q", F.col("_total") / F.col("_rank") * F.col(p_col))
    adjusted = ordered_scan(ranked, keys, p_col, "_tile", [Scan("_qmin", "min", "_q", reverse=True)])
    lookup = adjusted.select(*keys, p_col, "_n", F.least(F.lit(1.0), "_qmin").alias("p_adj"))
    joined = lookup_join(df, lookup, hist, [*keys, p_col], "_n")
    return joined.select(*df.columns, "p_adj", (F.col("p_adj") < alpha).cast("tinyint").alias("sig"))


def conserved_sites(df: DataFrame) -> DataFrame:
    """Significant conserved sites as (chrom, start, end, sig_code), sig_code being "01"."""
    return (df.where((F.col("status") == 0) & (F.col("sig") == 1))
            .select("chrom", "start", "end", F.concat(F.col("status").cast("string"), F.col("sig").cast("string"))
                    .alias("sig_code")))


def high_depth(depth: DataFrame, threshold: int, sort: bool = False) -> DataFrame:
    """Depth rows strictly above the threshold, optionally in (chrom, start) order."""
    kept = depth.where(F.col("depth") > threshold)
    return kept.orderBy("chrom", "start") if sort else kept


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def depth_histogram(depth: DataFrame) -> DataFrame:
    """Bases per (chrom, depth); a depth run counts as end - start bases."""
    return depth.groupBy("chrom", "depth").agg(F.sum(F.col("end") - F.col("start")).alias("n"))


def label_sites(depth: DataFrame, conserved: DataFrame) -> DataFrame:
    """Every depth site with ``conserved`` true or false, from an equi-join on (chrom, start)."""
    labels = conserved.select("chrom", "start").distinct().withColumn("conserved", F.lit(True))
    return depth.join(labels, ["chrom", "start"], "left").withColumn(
        "conserved", F.coalesce("conserved", F.lit(False)))


def depth_by_conserved(labelled: DataFrame) -> DataFrame:
    """Box-plot statistics of depth per conserved flag. Depth is bounded by the number of aligned
    species, so the weighted percentile sees one small histogram per flag."""
    hist = labelled.groupBy("conserved", "depth").agg(F.count(F.lit(1)).alias("n"))
    q = F.expr("percentile(depth, array(0.25, 0.5, 0.75), n)")
    return (hist.groupBy("conserved").agg(F.sum("n").alias("n"), F.min("depth").alias("min_depth"), q.alias("q"),
                                          F.max("depth").alias("max_depth"))
            .select("conserved", "n", "min_depth", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                    F.col("q")[2].alias("q3"), "max_depth"))


def exclude_chroms(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.where(~F.col("chrom").isin(*names))


def include_chroms(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.where(F.col("chrom").isin(*names))


def normalize_chrom(df: DataFrame, prefix: str = "chr", pattern: str | None = None) -> DataFrame:
    """Prefix chromosome names that lack it; with ``pattern``, keep only names that match it
    (tested on the name without prefix)."""
    bare = F.regexp_replace("chrom", f"^{prefix}", "")
    kept = df.where(bare.rlike(pattern)) if pattern else df
    return kept.withColumn("chrom", F.concat(F.lit(prefix), bare))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def clamp(col: Column | str, low: float = 1e-10, high: float = 0.9999999999) -> Column:
    """Keep a probability away from 0 and 1."""
    c = F.col(col) if isinstance(col, str) else col
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))
