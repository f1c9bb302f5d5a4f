"""Site-level queries: scores, significance, depth, distances and distribution tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from basetide import adapters as A
from basetide.catalog.common import as_long, fragment, merged_sql, query, r6
from basetide.operators import intervals, sites, stats
from basetide.operators.cluster import cluster_extents, cluster_positions, cluster_summary, distinct_clusters
from basetide.plans import pipelines
from basetide.plans.lineage import cut
from basetide.plans.ordered import exact_quantiles


def _classified(spark, d):
    return sites.classify_scores(A.sites(spark, d))


def _conserved(spark, d):
    return pipelines.conserved(A.sites(spark, d))


def _conserved_table(spark, d):
    """The conserved sites written once, for queries that scan them several times."""
    return cut(_conserved(spark, d))


@query("score_status", """
  SELECT chrom, start, score, CAST(status AS INTEGER) AS status, round(p, 9) AS p_value FROM v_scored""")
def score_status(spark, d):
    return _classified(spark, d).select("chrom", "start", "score", F.col("status").cast("int").alias("status"),
                                        r6("p_value", "p_value", 9))


@query("bh_genome", "SELECT chrom, start, status, round(p_adj, 6) AS p_adj, sig FROM v_bh")
def bh_genome(spark, d):
    adjusted = sites.bh_adjust(_classified(spark, d))
    return adjusted.select("chrom", "start", F.col("status").cast("int").alias("status"), r6("p_adj", "p_adj"),
                           F.col("sig").cast("int").alias("sig"))


@query("bh_per_chrom", "SELECT chrom, start, status, round(p_adj, 6) AS p_adj, sig FROM v_bh_chrom")
def bh_per_chrom(spark, d):
    adjusted = sites.bh_adjust(_classified(spark, d), scope="chrom")
    return adjusted.select("chrom", "start", F.col("status").cast("int").alias("status"), r6("p_adj", "p_adj"),
                           F.col("sig").cast("int").alias("sig"))


@query("conserved_sites", 'SELECT chrom, start, "end", sig_code FROM v_cons')
def conserved_sites(spark, d):
    return _conserved(spark, d)


@query("conserved_counts", "SELECT chrom, count(*) AS n FROM v_cons GROUP BY chrom")
def conserved_counts(spark, d):
    return sites.count_by(_conserved(spark, d), "chrom")


@query("significance_counts", """
  SELECT CAST(status AS VARCHAR) || CAST(sig AS VARCHAR) AS sig_code, count(*) AS n FROM v_bh GROUP BY 1""")
def significance_counts(spark, d):
    adjusted = sites.bh_adjust(_classified(spark, d))
    code = F.concat(F.col("status").cast("string"), F.col("sig").cast("string"))
    return sites.count_by(adjusted.withColumn("sig_code", code), "sig_code")


@query("high_depth_sites", 'SELECT chrom, start, "end", depth FROM v_depth WHERE depth > 80')
def high_depth_sites(spark, d):
    return sites.high_depth(A.depth(spark, d), 80, sort=True)


@query("depth_counts", 'SELECT chrom, depth, CAST(sum("end" - start) AS BIGINT) AS n FROM v_depth GROUP BY ALL')
def depth_counts(spark, d):
    return sites.depth_histogram(A.depth(spark, d))


@query("conserved_high_depth", """
  SELECT d.chrom, d.start, d."end", d.depth, c.start AS b_start, c.sig_code AS b_sig_code, CAST(1 AS BIGINT) AS overlap
  FROM v_depth d JOIN v_cons c ON d.chrom = c.chrom AND d.start = c.start WHERE d.depth > 80""")
def conserved_high_depth(spark, d):
    pairs = intervals.point_join(sites.high_depth(A.depth(spark, d), 80), _conserved(spark, d))
    return pairs.select("chrom", "start", "end", "depth", "b_start", "b_sig_code", "overlap")


@query("conserved_high_depth_counts", """
  SELECT c.sig_code, count(*) AS n FROM v_depth d JOIN v_cons c ON d.chrom = c.chrom AND d.start = c.start
  WHERE d.depth > 80 GROUP BY 1""")
def conserved_high_depth_counts(spark, d):
    pairs = intervals.point_join(sites.high_depth(A.depth(spark, d), 80), _conserved(spark, d))
    return sites.count_by(pairs, "b_sig_code").withColumnRenamed("b_sig_code", "sig_code")


@query("labelled_depth", """
  SELECT d.chrom, d.start, d.depth, c.start IS NOT NULL AS conserved
  FROM v_depth d LEFT JOIN v_cons c ON d.chrom = c.chrom AND d.start = c.start""")
def labelled_depth(spark, d):
    return sites.label_sites(A.depth(spark, d), _conserved(spark, d)).select("chrom", "start", "depth", "conserved")


@query("depth_by_conserved", """
  SELECT c.start IS NOT NULL AS conserved, count(*) AS n, min(depth) AS min_depth,
         CAST(quantile_cont(depth, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont(depth, 0.5) AS DOUBLE) AS median,
         CAST(quantile_cont(depth, 0.75) AS DOUBLE) AS q3, max(depth) AS max_depth
  FROM v_depth d LEFT JOIN v_cons c ON d.chrom = c.chrom AND d.start = c.start GROUP BY 1""")
def depth_by_conserved(spark, d):
    return sites.depth_by_conserved(sites.label_sites(A.depth(spark, d), _conserved(spark, d)))


@query("autosome_sites", """
  SELECT 'chr' || chrom AS chrom, count(*) AS n FROM v_sites
  WHERE chrom NOT IN ('error', 'signup') AND regexp_matches(chrom, '^[a-z]+$') GROUP BY 1""")
def autosome_sites(spark, d):
    kept = sites.exclude_chroms(A.sites(spark, d), ["error", "signup"])
    return sites.count_by(sites.normalize_chrom(kept, "chr", "^[a-z]+$"), "chrom")


@query("included_sites", "SELECT chrom, count(*) AS n FROM v_sites WHERE chrom IN ('click', 'view') GROUP BY 1")
def included_sites(spark, d):
    return sites.count_by(sites.include_chroms(A.sites(spark, d), ["click", "view"]), "chrom")


@query("union_of_sites", """
  SELECT chrom, count(*) AS n FROM (SELECT chrom, start FROM v_cons UNION ALL SELECT chrom, start FROM v_depth)
  GROUP BY chrom""")
def union_of_sites(spark, d):
    parts = [f.select("chrom", "start") for f in (_conserved(spark, d), A.depth(spark, d))]
    return sites.count_by(sites.union_all(parts), "chrom")


@query("clamped_probabilities", """
  SELECT chrom, start, round(greatest(least(p, 0.9999999999), 1e-10), 8) AS p FROM v_scored""")
def clamped_probabilities(spark, d):
    return _classified(spark, d).select("chrom", "start", F.round(sites.clamp("p_value"), 8).alias("p"))


@query("percent_conserved", """
  SELECT c.chrom, c.n, l.length, round(c.n / l.length * 100, 6) AS percent
  FROM (SELECT chrom, count(*) AS n FROM v_cons GROUP BY chrom) c LEFT JOIN v_chromes l ON c.chrom = l.chrom""")
def percent_conserved(spark, d):
    out = stats.percent_of_length(sites.count_by(_conserved(spark, d), "chrom"), A.chromes(spark, d))
    return out.withColumn("percent", F.round("percent", 6))


@query("chrom_summary", """
  SELECT round(avg(n), 6) AS mean_count, CAST(median(n) AS DOUBLE) AS median_count,
         round(avg(n / length * 100), 6) AS mean_percent, round(median(n / length * 100), 6) AS median_percent
  FROM (SELECT chrom, count(*) AS n FROM v_cons GROUP BY chrom) JOIN v_chromes USING (chrom)""")
def chrom_summary(spark, d):
    out = stats.chrom_summary(stats.percent_of_length(sites.count_by(_conserved(spark, d), "chrom"), A.chromes(spark, d)))
    return out.select(r6("mean_count", "mean_count"), r6("median_count", "median_count"),
                      r6("mean_percent", "mean_percent"), r6("median_percent", "median_percent"))


@query("ordered_chroms", "SELECT chrom, length FROM v_chromes ORDER BY chrom")
def ordered_chroms(spark, d):
    return stats.order_chroms(A.chromes(spark, d), A.chromes(spark, d))


fragment("v_dist", """
  SELECT chrom, start, start - lag(start) OVER (PARTITION BY chrom ORDER BY start) AS inter_dist FROM v_cons""")


@query("inter_site_distance", """
  SELECT chrom, start, inter_dist, round(log10(inter_dist), 6) AS log_inter_dist FROM v_dist""")
def inter_site_distance(spark, d):
    out = stats.inter_site_distance(_conserved(spark, d))
    return out.select("chrom", "start", "inter_dist", r6("log_inter_dist", "log_inter_dist"))


@query("distance_histogram", """
  SELECT chrom, inter_dist // 3600 AS bin, count(*) AS n, inter_dist // 3600 * 3600 AS bin_start
  FROM v_dist WHERE inter_dist IS NOT NULL GROUP BY ALL""")
def distance_histogram(spark, d):
    return intervals.histogram(stats.inter_site_distance(_conserved(spark, d)), "inter_dist", 3600, ["chrom"])


@query("distance_quantiles", """
  SELECT chrom, round(quantile_cont(inter_dist, 0.1), 6) AS q10, round(quantile_cont(inter_dist, 0.5), 6) AS q50,
         round(quantile_cont(inter_dist, 0.9), 6) AS q90 FROM v_dist WHERE inter_dist IS NOT NULL GROUP BY chrom""")
def distance_quantiles(spark, d):
    q = exact_quantiles(stats.inter_site_distance(_conserved_table(spark, d)), ["chrom"], "inter_dist",
                        {"q10": 0.1, "q50": 0.5, "q90": 0.9})
    return q.select("chrom", *[r6(c, c) for c in ("q10", "q50", "q90")])


@query("ntile_counts", """
  SELECT chrom, CAST(bin AS INTEGER) AS bin, count(*) AS n
  FROM (SELECT chrom, ntile(100) OVER (PARTITION BY chrom ORDER BY start) AS bin FROM v_sites) GROUP BY ALL""")
def ntile_counts(spark, d):
    return stats.ntile_bins(A.sites(spark, d), 100)


fragment("v_bins", """
  SELECT s.chrom, s.bin, coalesce(c.n, 0) AS n
  FROM (SELECT chrom, unnest(range(1, (length + 9999) // 10000 + 1)) AS bin FROM v_chromes) s
  LEFT JOIN (SELECT chrom, start // 10000 + 1 AS bin, count(*) AS n FROM v_cons GROUP BY ALL) c
  ON s.chrom = c.chrom AND s.bin = c.bin""")


@query("binned_sites", "SELECT chrom, bin, n FROM v_bins")
def binned_sites(spark, d):
    return intervals.binned_counts(_conserved_table(spark, d), A.chromes(spark, d), 10000)


@query("chisq_uniform", """
  SELECT chrom, count(*) AS bins, CAST(sum(n) AS BIGINT) AS total, round(sum(pow(n - e, 2) / e), 6) AS statistic,
         count(*) - 1 AS df
  FROM (SELECT *, sum(n) OVER (PARTITION BY chrom) / count(*) OVER (PARTITION BY chrom) AS e FROM v_bins)
  GROUP BY chrom""")
def chisq_uniform(spark, d):
    out = stats.chisq_uniform(intervals.binned_counts(_conserved_table(spark, d), A.chromes(spark, d), 10000))
    return out.withColumn("statistic", F.round("statistic", 6))


@query("chisq_uniform_p", """
  SELECT chrom, bins, total, round(statistic, 6) AS statistic, df,
         round(greatest(0, 1 - list_sum(list_transform(range(0, CAST(statistic + 40 * sqrt(statistic) + 300 AS BIGINT)),
           lambda k: exp((df / 2 + k) * ln(statistic / 2) - statistic / 2 - lgamma(df / 2 + k + 1))))), 6) AS p_value
  FROM (SELECT chrom, count(*) AS bins, CAST(sum(n) AS BIGINT) AS total, sum(pow(n - e, 2) / e) AS statistic, count(*) - 1 AS df
        FROM (SELECT *, sum(n) OVER (PARTITION BY chrom) / count(*) OVER (PARTITION BY chrom) AS e FROM v_bins)
        GROUP BY chrom)""")
def chisq_uniform_p(spark, d):
    out = stats.with_chisq_p(stats.chisq_uniform(intervals.binned_counts(_conserved_table(spark, d), A.chromes(spark, d), 10000)))
    return out.withColumn("statistic", F.round("statistic", 6)).withColumn("p_value", F.round("p_value", 6))


@query("chisq_by_length", """
  SELECT count(*) AS chroms, CAST(sum(n) AS BIGINT) AS total, round(sum(pow(n - e, 2) / e), 6) AS statistic,
         count(*) - 1 AS df
  FROM (SELECT c.n, l.length / sum(l.length) OVER () * sum(c.n) OVER () AS e
        FROM v_chromes l JOIN (SELECT chrom, count(*) AS n FROM v_cons GROUP BY chrom) c USING (chrom))""")
def chisq_by_length(spark, d):
    out = stats.chisq_by_length(sites.count_by(_conserved_table(spark, d), "chrom"), A.chromes(spark, d))
    return out.withColumn("statistic", F.round("statistic", 6))


KS_TAIL = """CASE WHEN {x} < 0.02 THEN 1.0 ELSE greatest(0.0, least(1.0, list_sum(list_transform(range(1, 101),
  lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * {x}))))) END"""


@query("ks_exponential", f"""
  SELECT n, round(rate, 9) AS rate, round(statistic, 6) AS statistic,
         round({KS_TAIL.format(x="(n * statistic * statistic)")}, 6) AS p_value
  FROM (SELECT count(*) AS n, max(1 / mean) AS rate,
               max(greatest(abs(hi / total - cdf), abs(lo / total - cdf))) AS statistic
        FROM (SELECT count(*) OVER (ORDER BY inter_dist) AS hi,
                     count(*) OVER () - count(*) OVER (ORDER BY inter_dist DESC) AS lo, count(*) OVER () AS total,
                     avg(inter_dist) OVER () AS mean, 1 - exp(-inter_dist / avg(inter_dist) OVER ()) AS cdf
              FROM v_dist WHERE inter_dist IS NOT NULL))""")
def ks_exponential(spark, d):
    out = stats.ks_exponential(stats.inter_site_distance(_conserved_table(spark, d)))
    return out.select("n", r6("rate", "rate", 9), r6("statistic", "statistic"), r6("p_value", "p_value"))


@query("ks_uniform", f"""
  SELECT chrom, n, round(statistic, 6) AS statistic, round(p, 6) AS p_value,
         round(least(1.0, p * count(*) OVER ()), 6) AS p_corrected, least(1.0, p * count(*) OVER ()) < 0.01 AS flagged
  FROM (SELECT chrom, n, statistic, {KS_TAIL.format(x="(n / 2 * statistic * statistic)")} AS p
        FROM (SELECT chrom, CAST(max(na) AS BIGINT) AS n, max(abs(ca / na - cb / nb)) AS statistic
              FROM (SELECT chrom, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY chrom) AS na,
                           sum(b) OVER (PARTITION BY chrom) AS nb
                    FROM (SELECT chrom, CAST(start AS DOUBLE) AS x, 1 AS a, 0 AS b FROM v_cons UNION ALL
                          SELECT c.chrom, 1 + CAST('0x' || substr(md5('1:' || c.chrom || ':' || c.start), 1, 12) AS BIGINT)
                                 / 281474976710656.0 * (l.length - 1), 0, 1
                          FROM v_cons c JOIN v_chromes l ON c.chrom = l.chrom)
                    WINDOW w AS (PARTITION BY chrom ORDER BY x))
              GROUP BY chrom))""")
def ks_uniform(spark, d):
    out = stats.ks_uniform(_conserved_table(spark, d), A.chromes(spark, d), seed=1)
    return out.select("chrom", "n", *[r6(c, c) for c in ("statistic", "p_value", "p_corrected")], "flagged")


def cluster_sql(source: str, m: int, size: int, eps: int) -> str:
    """Density clusters by plain windows, for comparison."""
    return f"""
      SELECT chrom, start, CASE WHEN n_members >= {size} THEN island END AS island FROM (
        SELECT *, count(*) OVER (PARTITION BY chrom, island) AS n_members FROM (
          SELECT chrom, start,
                 CASE WHEN start - lft <= {eps} AND (rgt IS NULL OR start - lft <= rgt - start) THEN isl
                      WHEN rgt - start <= {eps} THEN CASE WHEN rgt - lft <= {eps} THEN isl ELSE rgt END END AS island
          FROM (SELECT *, max(opn) OVER (PARTITION BY chrom ORDER BY start) AS isl
                FROM (SELECT *, CASE WHEN core AND (bef IS NULL OR start - bef > {eps}) THEN start END AS opn
                      FROM (SELECT chrom, start, core, max(c) OVER (PARTITION BY chrom ORDER BY start) AS lft,
                                   max(c) OVER (PARTITION BY chrom ORDER BY start
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bef,
                                   min(c) OVER (PARTITION BY chrom ORDER BY start DESC) AS rgt
                            FROM (SELECT *, CASE WHEN core THEN start END AS c
                                  FROM (SELECT *, count(*) OVER (PARTITION BY chrom ORDER BY start
                                          RANGE BETWEEN {eps} PRECEDING AND {eps} FOLLOWING) >= {m} AS core
                                        FROM {source})))))))"""


def extents_sql(labelled: str) -> str:
    return f"""
      SELECT chrom, start, "end", 'cluster_' || (row_number() OVER (PARTITION BY chrom ORDER BY start_id) - 1) AS cluster_id,
             num_conserved
      FROM (SELECT chrom, island AS start_id, min(start) AS start, max(start) AS "end", count(*) AS num_conserved
            FROM ({labelled}) WHERE island IS NOT NULL GROUP BY chrom, island)"""


EPS = 5000


@query("site_clusters", extents_sql(cluster_sql("v_cons", 4, 5, EPS)))
def site_clusters(spark, d):
    return cluster_extents(cluster_positions(_conserved_table(spark, d), 5, 4, EPS))


@query("distinct_clusters", f"""
  SELECT chrom, count(*) AS n FROM ({extents_sql(cluster_sql("v_cons", 4, 5, EPS))}) GROUP BY chrom""")
def distinct_cluster_counts(spark, d):
    return sites.count_by(distinct_clusters(cluster_positions(_conserved_table(spark, d), 5, 4, EPS)), "chrom")


fragment("v_core", """
  SELECT chrom, start, least(
    greatest(coalesce(start - lag(start, 2) OVER w, 1e18), 0),
    CASE WHEN lag(start, 1) OVER w IS NULL OR lead(start, 1) OVER w IS NULL THEN 1e18
         ELSE greatest(start - lag(start, 1) OVER w, lead(start, 1) OVER w - start) END,
    coalesce(lead(start, 2) OVER w - start, 1e18)) AS core_dist
  FROM v_cons WINDOW w AS (PARTITION BY chrom ORDER BY start)""")


@query("core_distances", "SELECT chrom, start, CAST(core_dist AS BIGINT) AS core_dist FROM v_core")
def core_distances(spark, d):
    from basetide.operators.cluster import core_distances as distances

    return distances(_conserved_table(spark, d), 3).select("chrom", "start", "core_dist")


CLUSTER_PAIRS = [(5, 3), (8, 3), (5, 4), (8, 4)]
fragment("v_clusters", " UNION ALL ".join(
    f'SELECT *, {size} AS min_cluster_size, {m} AS min_samples FROM ({extents_sql(cluster_sql("v_cons", m, size, EPS))})'
    for size, m in CLUSTER_PAIRS))


@query("cluster_grid_summary", """
  SELECT min_cluster_size, min_samples, count(*) AS num_clusters, CAST(sum("end" - start) AS BIGINT) AS total_length,
         round(avg("end" - start), 6) AS mean_length, CAST(sum(num_conserved) AS BIGINT) AS sites_in_clusters,
         round(avg(num_conserved), 6) AS mean_sites, round(avg(num_conserved / ("end" - start)), 6) AS mean_density,
         round(quantile_cont("end" - start, 0.5), 6) AS median_length,
         round(quantile_cont(num_conserved, 0.5), 6) AS median_sites,
         round(quantile_cont(num_conserved / ("end" - start), 0.5), 6) AS median_density,
         (SELECT CAST(sum(length) AS BIGINT) FROM v_chromes) AS total_sites,
         (SELECT count(*) FROM v_cons) AS total_conserved,
         round((SELECT count(*) FROM v_cons) / (SELECT sum(length) FROM v_chromes), 9) AS conserved_share,
         round(sum(num_conserved) / (SELECT count(*) FROM v_cons), 6) AS share_in_clusters
  FROM v_clusters GROUP BY min_cluster_size, min_samples""")
def cluster_grid_summary(spark, d):
    cons = _conserved_table(spark, d)
    found = cut(pipelines.cluster_grid(cons, [5, 8], [3, 4], EPS))
    out = cluster_summary(found, sites.count_by(cons, "chrom"), A.chromes(spark, d))
    for c in ("mean_length", "mean_sites", "mean_density", "median_length", "median_sites", "median_density",
              "share_in_clusters"):
        out = out.withColumn(c, F.round(F.col(c).cast("double"), 6))
    out = out.withColumn("conserved_share", F.round("conserved_share", 9))
    return as_long(out, "total_length", "sites_in_clusters", "total_sites", "total_conserved")


@query("conserved_elements", f"""
  SELECT chrom, count(*) AS n_elements, CAST(sum("end" - start) AS BIGINT) AS bases
  FROM ({merged_sql("SELECT * FROM v_wincount WHERE n >= 2", 5)}) GROUP BY chrom""")
def conserved_elements(spark, d):
    merged = pipelines.conserved_elements(_conserved_table(spark, d), A.chromes(spark, d), 21600, 2)
    return intervals.element_totals(merged, "chrom")


fragment("v_deepcount", """
  SELECT t.depth_cutoff, d.chrom, d.start // 21600 AS window_no, count(*) AS n
  FROM v_depth d JOIN v_cons c ON d.chrom = c.chrom AND d.start = c.start,
       (SELECT unnest([40, 80, 120]) AS depth_cutoff) t
  WHERE d.depth > t.depth_cutoff GROUP BY ALL""")
fragment("v_deepwin", """
  SELECT c.depth_cutoff, k.site_cutoff, w.chrom, w.start, w."end"
  FROM v_deepcount c JOIN v_win w ON c.chrom = w.chrom AND c.window_no = w.window_no,
       (SELECT unnest([1, 2, 3]) AS site_cutoff) k WHERE c.n >= k.site_cutoff""")


@query("element_grid", f"""
  SELECT depth_cutoff, site_cutoff, chrom, count(*) AS n_elements, CAST(sum("end" - start) AS BIGINT) AS bases
  FROM ({merged_sql("SELECT * FROM v_deepwin", 5, "depth_cutoff, site_cutoff, chrom")}) GROUP BY ALL""")
def element_grid(spark, d):
    found = pipelines.element_grid(_conserved_table(spark, d), A.depth(spark, d), A.chromes(spark, d), 21600,
                                   [40, 80, 120], [1, 2, 3])
    return intervals.element_totals(found, "depth_cutoff", "site_cutoff", "chrom")
