"""Distances, equal-count bins, chi-square and Kolmogorov-Smirnov statistics."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basetide.operators.intervals import indexed_length
from basetide.plans.ordered import (TILE_WIDTH, Scan, ordered_scan, placed, position_tile,
                                    value_tiles)


def inter_site_distance(sites: DataFrame, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Distance of each position to the previous one on its chromosome, and its log10.

    One row per distinct position; ``copies`` counts the sites there. Copies beyond the first are
    at distance 0, which counts as missing, so they have no row of their own.
    """
    rows = (placed(sites, "chrom", "start").groupBy("chrom", "start").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("_tile", position_tile("start", tile_width)))
    prev = ordered_scan(rows, ["chrom"], "start", "_tile", [Scan("_prev", "last", "start", inclusive=False)])
    dist = F.col("start") - F.col("_prev")
    return prev.select("chrom", "start", "copies", dist.alias("inter_dist"),
                       F.log10(dist.cast("double")).alias("log_inter_dist"))


def ntile_bins(sites: DataFrame, buckets: int = 100, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Sites per equal-count bucket of ``start`` within a chromosome.

    ``ntile`` needs a whole chromosome in one task. Here every distinct position knows the ranks it
    covers (a running count), and the ranks are split over the buckets by arithmetic: with n rows
    and k buckets the first n mod k buckets hold one row more.
    """
    rows = (placed(sites, "chrom", "start").groupBy("chrom", "start").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_tile", position_tile("start", tile_width)))
    cum = ordered_scan(rows, ["chrom"], "start", "_tile",
                       [Scan("_last", "sum", "_n"), Scan("_all", "total", "_n")])
    size, extra = F.floor(F.col("_all") / buckets), F.col("_all") % buckets
    big = extra * (size + 1)

    def bucket_of(rank: Column) -> Column:
        return F.when(rank < big, F.floor(rank / (size + 1))).otherwise(extra + F.floor((rank - big) / size))

    def first_rank(b: Column) -> Column:
        return F.when(b <= extra, b * (size + 1)).otherwise(big + (b - extra) * size)

    lo, hi = F.col("_last") - F.col("_n"), F.col("_last")
    parts = cum.withColumn("_b", F.explode(F.sequence(bucket_of(lo), bucket_of(hi - 1))))
    b = F.col("_b")
    share = F.least(hi, first_rank(b + 1)) - F.greatest(lo, first_rank(b))
    return (parts.groupBy("chrom", (b + 1).cast("int").alias("bin"))
            .agg(F.sum(share).cast("long").alias("n")))


def chisq_uniform(binned: DataFrame) -> DataFrame:
    """Goodness of fit of binned counts against equal expectation, per chromosome.

    With equal expectation e = total / bins the statistic is sum(n^2) / e - total, one aggregate.
    """
    sums = binned.groupBy("chrom").agg(F.count(F.lit(1)).alias("bins"), F.sum("n").alias("total"),
                                       F.sum(F.col("n").cast("double") * F.col("n")).alias("sq"))
    stat = F.col("sq") * F.col("bins") / F.col("total") - F.col("total")
    return sums.select("chrom", "bins", "total", stat.alias("statistic"), (F.col("bins") - 1).alias("df"))


def chisq_by_length(counts: DataFrame, chromes: DataFrame) -> DataFrame:
    """Per-chromosome totals against expectation proportional to chromosome length: one row."""
    joined = chromes.select("chrom", "length").join(
        counts.groupBy("chrom").agg(F.sum("n").alias("n")), "chrom", "left").na.fill({"n": 0})
    sums = joined.agg(F.sum(F.pow(F.col("n").cast("double"), 2) / F.col("length")).alias("w"),
                      F.sum("length").alias("len"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))
    stat = F.col("w") * F.col("len") / F.col("total") - F.col("total")
    return sums.select(F.col("k").alias("chroms"), "total", stat.alias("statistic"), (F.col("k") - 1).alias("df"))


def with_chisq_p(stats: DataFrame) -> DataFrame:
    """Add the upper-tail p-value of ``statistic`` with ``df`` degrees of freedom."""
    return stats.withColumn("p_value", _chisq_tail("statistic", "df"))


@F.pandas_udf(T.DoubleType())
def _chisq_tail(stat: pd.Series, df: pd.Series) -> pd.Series:
    pairs = zip(stat.to_numpy(dtype=float), df.to_numpy(dtype=float))
    return pd.Series([upper_gamma(d / 2, s / 2) for s, d in pairs], dtype=float)


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if math.isnan(a) or math.isnan(x) or a <= 0:
        return math.nan
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    terms = int(60 + 12 * math.sqrt(max(a, x)))
    if x < a + 1:
        # lower series: sum of x^k / (a (a+1) ... (a+k))
        ratios = x / (a + np.arange(1, terms))
        return float(max(0.0, 1 - scale / a * (1 + np.cumprod(ratios).sum())))
    # continued fraction x+1-a - 1(1-a)/(x+3-a - 2(2-a)/(x+5-a - ...)), folded from the far end
    tail = x + 2 * terms + 1 - a
    for k in range(terms, 0, -1):
        tail = x + 2 * k - 1 - a - k * (k - a) / tail
    return float(min(1.0, scale / tail))


def kolmogorov_tail(d: Column, n_eff: Column, terms: int = 100) -> Column:
    """Asymptotic p of a KS distance: 2 sum (-1)^(k-1) exp(-2 k^2 n d^2), within [0, 1]."""
    x = n_eff * d * d
    total = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda acc, k: acc + F.when(
        k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * x))
    return F.when(x < 0.02, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def ks_exponential(df: DataFrame, col: str = "inter_dist", tiles: int | None = None) -> DataFrame:
    """One-sample KS against the exponential with rate 1 / mean, all rows together: one row."""
    tiled = value_tiles(df.where(F.col(col).isNotNull()), col, tiles=tiles)
    hist = tiled.groupBy("_tile", col).agg(F.count(F.lit(1)).alias("n"))
    h = ordered_scan(hist.withColumn("_vn", F.col(col) * F.col("n")), [], col, "_tile", [
        Scan("cum", "sum", "n"), Scan("total", "total", "n"), Scan("_sum", "total", "_vn")])
    h = h.withColumn("mean", F.col("_sum") / F.col("total"))
    cdf = 1 - F.exp(-F.col(col) / F.col("mean"))
    gap = F.greatest(F.abs(F.col("cum") / F.col("total") - cdf),
                     F.abs((F.col("cum") - F.col("n")) / F.col("total") - cdf))
    out = h.agg(F.max("mean").alias("mean"), F.max("total").alias("n"), F.max(gap).alias("statistic"))
    return out.select("n", (1 / F.col("mean")).alias("rate"), "statistic",
                      kolmogorov_tail(F.col("statistic"), F.col("n")).alias("p_value"))


def uniform_null(sites: DataFrame, chromes: DataFrame, seed: int = 1) -> DataFrame:
    """One pseudo-random position in [1, length] per site. The draw is a hash of (seed, chrom,
    start), so a recomputed task draws the same number. Hash: first 12 hex digits of md5 / 2^48."""
    key = F.concat_ws(":", F.lit(str(seed)), F.col("chrom"), F.col("start").cast("string"))
    unit = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    return (indexed_length(sites.select("chrom", "start"), chromes)
            .select("chrom", (1 + unit * (F.col("length") - 1)).alias("x")))


def ks_uniform(sites: DataFrame, chromes: DataFrame, seed: int = 1, alpha: float = 0.01,
               tiles: int | None = None) -> DataFrame:
    """Two-sample KS of site positions against a uniform sample of the same size, per chromosome,
    with a Bonferroni-corrected p (times the number of chromosomes, at most 1) and a flag."""
    observed = sites.select("chrom", F.col("start").cast("double").alias("x"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    null = uniform_null(sites, chromes, seed).select("chrom", "x", F.lit(0).alias("a"), F.lit(1).alias("b"))
    both = value_tiles(observed.union(null), "x", tiles=tiles)
    hist = both.groupBy("chrom", "_tile", "x").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    cum = ordered_scan(hist, ["chrom"], "x", "_tile", [
        Scan("ca", "sum", "a"), Scan("cb", "sum", "b"), Scan("na", "total", "a"), Scan("nb", "total", "b")])
    gap = F.abs(F.col("ca") / F.col("na") - F.col("cb") / F.col("nb"))
    per_chrom = cum.groupBy("chrom").agg(F.max("na").alias("n"), F.max(gap).alias("statistic"))
    p = kolmogorov_tail(F.col("statistic"), F.col("n") / 2)
    # the report has one row per chromosome, so this window is as small as the report
    report = Window.partitionBy(F.lit(1))
    out = per_chrom.withColumn("p_value", p).withColumn("_tests", F.count(F.lit(1)).over(report))
    corrected = F.least(F.lit(1.0), F.col("p_value") * F.col("_tests"))
    return out.select("chrom", "n", "statistic", "p_value", corrected.alias("p_corrected"),
                      (corrected < alpha).alias("flagged"))


def percent_of_length(counts: DataFrame, chromes: DataFrame) -> DataFrame:
    """Chromosome counts with chromosome length and the percent of bases counted."""
    return with_length(counts, chromes).withColumn("percent", F.col("n") / F.col("length") * 100)


def with_length(counts: DataFrame, chromes: DataFrame) -> DataFrame:
    return counts.join(chromes.select("chrom", "length"), "chrom", "left")


def chrom_summary(percents: DataFrame) -> DataFrame:
    """Mean and median of counts and percents over a per-chromosome report (one row per chromosome,
    which bounds the exact percentile)."""
    return percents.agg(F.avg("n").alias("mean_count"), F.median("n").alias("median_count"),
                        F.avg("percent").alias("mean_percent"), F.median("percent").alias("median_percent"))


def order_chroms(df: DataFrame, chromes: DataFrame) -> DataFrame:
    """Sort by natural chromosome order: numbers first, ascending, then the other names."""
    number = F.regexp_extract("chrom", r"(\d+)$", 1).try_cast("int")
    ordered = df.withColumn("_no", number)
    if "ord" in chromes.columns:
        ordered = df.join(chromes.select("chrom", F.col("ord").alias("_no")), "chrom", "left")
    tail = [c for c in ("start",) if c in df.columns]
    return ordered.orderBy(F.col("_no").asc_nulls_last(), "chrom", *tail).drop("_no")


