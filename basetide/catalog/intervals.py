"""Interval queries: windows, overlaps, merging, packing and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from basetide import adapters as A
from basetide.catalog.common import merged_sql, query, r6
from basetide.operators import intervals as I
from basetide.plans import pipelines


@query("windows", 'SELECT chrom, start, "end", window_no FROM v_win')
def windows(spark, d):
    return I.make_windows(A.chromes(spark, d), 21600)


@query("numbered_windows", """
  SELECT chrom, start, "end", row_number() OVER (PARTITION BY chrom ORDER BY start) - 1 AS win_no,
         CASE WHEN window_no < 100 THEN lpad(CAST(window_no AS VARCHAR), 2, '0') ELSE CAST(window_no AS VARCHAR) END
         AS win_label FROM v_win""")
def numbered_windows(spark, d):
    return I.number_windows(I.make_windows(A.chromes(spark, d), 21600).drop("window_no"))


@query("chrom_extents", 'SELECT chrom, CAST(0 AS BIGINT) AS start, length - 1 AS "end" FROM v_chromes WHERE chrom <> \'view\'')
def chrom_extents(spark, d):
    return I.chrom_extents(A.chromes(spark, d), ["click", "error", "purchase", "signup"])


@query("window_site_counts", 'SELECT chrom, start, "end", window_no, n FROM v_wincount')
def window_site_counts(spark, d):
    return I.window_counts(I.make_windows(A.chromes(spark, d), 21600), pipelines.conserved(A.sites(spark, d)), 21600)


@query("windows_by_count", "SELECT n AS n_sites, count(*) AS n_windows FROM v_wincount GROUP BY n")
def windows_by_count(spark, d):
    return I.windows_by_count(window_site_counts(spark, d))


@query("overlap_pairs", """
  SELECT a.chrom, a.start, a."end", a.part, b.start AS b_start, b."end" AS b_end, b.cust AS b_cust,
         least(a."end", b."end") - greatest(a.start, b.start) AS overlap
  FROM v_iv a JOIN v_probe b ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" """)
def overlap_pairs(spark, d):
    pairs = I.overlap_join(A.intervals(spark, d), A.probes(spark, d))
    return pairs.select("chrom", "start", "end", "part", "b_start", "b_end", "b_cust", "overlap")


@query("overlap_counts", """
  SELECT a.chrom, a.start, a."end", a.cust, count(b.start) AS n
  FROM (SELECT *, row_number() OVER () AS rid FROM v_probe) a
  LEFT JOIN v_iv b ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end"
  GROUP BY a.rid, a.chrom, a.start, a."end", a.cust""")
def overlap_counts(spark, d):
    return I.overlap_count(A.probes(spark, d), A.intervals(spark, d))


# intervals that start together are one step: row frames would leave to chance which of several equal rows opens an island
@query("merged_intervals", """
  SELECT chrom, min(start) AS start, max("end") AS "end", count(*) AS n_merged
  FROM (SELECT *, sum(CASE WHEN reach IS NULL OR start - reach > 5 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY chrom ORDER BY start RANGE UNBOUNDED PRECEDING) AS isl
        FROM (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
              FROM v_iv))
  GROUP BY chrom, isl""")
def merged_intervals(spark, d):
    return I.merge_intervals(A.intervals(spark, d), 5, count=True)


@query("merged_bookended", merged_sql("SELECT * FROM v_probe", 0))
def merged_bookended(spark, d):
    return I.merge_intervals(A.probes(spark, d), 0, count=True)


@query("packed_runs", """
  SELECT chrom, min(start) AS start, max("end") AS "end", n
  FROM (SELECT *, sum(CASE WHEN pe = start AND pn = n THEN 0 ELSE 1 END)
                  OVER (PARTITION BY chrom ORDER BY start ROWS UNBOUNDED PRECEDING) AS isl
        FROM (SELECT *, lag("end") OVER (PARTITION BY chrom ORDER BY start) AS pe,
                     lag(n) OVER (PARTITION BY chrom ORDER BY start) AS pn FROM v_wincount))
  GROUP BY chrom, isl, n""")
def packed_runs(spark, d):
    return I.pack_runs(window_site_counts(spark, d), "n")


@query("expanded_runs", """
  SELECT chrom, cust, unnest(range(start, "end")) AS start FROM v_probe""")
def expanded_runs(spark, d):
    return I.expand_runs(A.probes(spark, d)).select("chrom", "cust", "start")


@query("length_classes", """
  SELECT CASE WHEN "end" - start <= 20 THEN 'short' WHEN "end" - start >= 45 THEN 'long' ELSE 'kept' END AS length_class,
         count(*) AS n, CAST(sum("end" - start) AS BIGINT) AS bases FROM v_iv GROUP BY 1""")
def length_classes(spark, d):
    labelled = I.length_filter(A.intervals(spark, d), 20, 45)
    return labelled.groupBy("length_class").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bases"))


@query("interval_density", """
  SELECT chrom, start, "end" - start AS length, round(cust / ("end" - start), 6) AS density FROM v_probe""")
def interval_density(spark, d):
    out = I.with_density(A.probes(spark, d), "cust")
    return out.select("chrom", "start", "length", r6("density", "density"))


@query("score_histogram", """
  SELECT chrom, bin, count(*) AS n, round(lo + bin * (hi - lo) / 30, 6) AS bin_start
  FROM (SELECT chrom, lo, hi, least(29, CAST(floor((score - lo) * 30 / (hi - lo)) AS BIGINT)) AS bin
        FROM v_sites, (SELECT min(score) AS lo, max(score) AS hi FROM v_sites)) GROUP BY chrom, bin, lo, hi""")
def score_histogram(spark, d):
    return I.histogram_bins(A.sites(spark, d), "score", 30, ["chrom"]).withColumn("bin_start", F.round("bin_start", 6))


@query("interval_histogram", """
  SELECT chrom, start // 1000 AS bin, count(*) AS n, start // 1000 * 1000 AS bin_start FROM v_iv GROUP BY ALL""")
def interval_histogram(spark, d):
    return I.histogram(A.intervals(spark, d), "start", 1000, ["chrom"])
