"""Segmentation and parameter-grid queries."""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import functions as F

from basetide import adapters as A
from basetide.catalog.common import FRAGMENTS, as_long, fragment, query, r6
from basetide.operators import grid, segment
from basetide.operators.segment import HmmParams
from basetide.plans import pipelines
from basetide.plans.lineage import cut

PARAMS = [HmmParams(0, 0.95, 0.9, 0.8, 0.6, 0.9), HmmParams(1, 0.2, 0.1, 0.3, 0.9, 1.0), HmmParams(2, 0.99, 0.97, 0.7, 0.6, 0.5)]
MIN_LEN, MAX_LEN = 3, 60


def _bases(spark, d):
    """Conserved sites and chromosomes on single positions."""
    return cut(pipelines.conserved(A.sites(spark, d))), A.chromes(spark, d)


def _sets_sql(sets) -> str:
    rows = ", ".join(f"({p.param_id}, {', '.join(f'CAST({v!r} AS DOUBLE)' for v in p.clamped())})" for p in sets)
    return f"SELECT * FROM (VALUES {rows}) t(param_id, t0, t1, e0, e1, s0)"


fragment("v_par", _sets_sql(PARAMS))
fragment("v_cpos", "SELECT DISTINCT chrom, start AS pos FROM v_cons")
fragment("v_run", """
  SELECT chrom, run, start, stop, CASE WHEN start IN (SELECT pos FROM v_cpos c WHERE c.chrom = r.chrom) THEN 1 ELSE 0 END AS x
  FROM (SELECT chrom, p AS start, lead(p) OVER w AS stop, row_number() OVER w - 1 AS run
        FROM (SELECT chrom, 0 AS p FROM v_chromes UNION SELECT chrom, 1 FROM v_chromes WHERE length > 1
              UNION SELECT chrom, length FROM v_chromes UNION SELECT chrom, pos FROM v_cpos UNION SELECT chrom, pos + 1 FROM v_cpos)
        WINDOW w AS (PARTITION BY chrom ORDER BY p)) r WHERE stop IS NOT NULL""")
# powers of the 2x2 update of each set and symbol: A^k = big^k (P + r^k Q)
fragment("v_update", """
  SELECT param_id, s0, e0, e1, x, (a00 - small) / (2 * root) AS p00, a01 / (2 * root) AS p01, a10 / (2 * root) AS p10,
         (a11 - small) / (2 * root) AS p11, (big - a00) / (2 * root) AS q00, -a01 / (2 * root) AS q01, -a10 / (2 * root) AS q10,
         (big - a11) / (2 * root) AS q11, small / big AS r,
         CAST(ceil(ln(1e-17) / ln(greatest(least(abs(small / big), 1 - 1e-12), 1e-300))) AS BIGINT) + 1 AS settled
  FROM (SELECT *, (a00 + a11) / 2 + root AS big, (a00 + a11) / 2 - root AS small
        FROM (SELECT *, sqrt(pow((a00 - a11) / 2, 2) + a01 * a10) AS root
              FROM (SELECT *, o0 * t0 AS a00, o0 * (1 - t1) AS a01, o1 * (1 - t0) AS a10, o1 * t1 AS a11
                    FROM (SELECT *, CASE x WHEN 0 THEN e0 ELSE 1 - e0 END AS o0, CASE x WHEN 0 THEN 1 - e1 ELSE e1 END AS o1
                          FROM v_par, (SELECT unnest([0, 1]) AS x)))))""")
# the filter behind every run, from run to run; the first base is a run of its own
fragment("v_filter", """
  SELECT param_id, chrom, run, n0 / (n0 + n1) AS a, n1 / (n0 + n1) AS b
  FROM (SELECT u.param_id, s.chrom, s.run, u.s0 * (CASE s.x WHEN 0 THEN u.e0 ELSE 1 - u.e0 END) AS n0,
               (1 - u.s0) * (CASE s.x WHEN 0 THEN 1 - u.e1 ELSE u.e1 END) AS n1
        FROM v_run s JOIN v_update u ON u.x = s.x WHERE s.run = 0)
  UNION ALL
  SELECT param_id, chrom, run, n0 / (n0 + n1), n1 / (n0 + n1)
  FROM (SELECT f.param_id, f.chrom, s.run, (p00 + pow(r, stop - start) * q00) * a + (p01 + pow(r, stop - start) * q01) * b AS n0,
               (p10 + pow(r, stop - start) * q10) * a + (p11 + pow(r, stop - start) * q11) * b AS n1
        FROM v_filter f JOIN v_run s ON f.chrom = s.chrom AND s.run = f.run + 1
        JOIN v_update u ON u.param_id = f.param_id AND u.x = s.x)""")
# base by base until the state of a run has settled, then the rest of it
fragment("v_piece", """
  SELECT param_id, chrom, start + k - 1 AS start, CASE WHEN k = n THEN stop ELSE start + k END AS stop, x,
         CASE WHEN (p10 + pow(r, k) * q10 - p00 - pow(r, k) * q00) * a + (p11 + pow(r, k) * q11 - p01 - pow(r, k) * q01) * b
                   > 1e-12 * ((p10 + pow(r, k) * q10 + p00 + pow(r, k) * q00) * a + (p11 + pow(r, k) * q11 + p01 + pow(r, k) * q01) * b)
              THEN 1 ELSE 0 END AS state
  FROM (SELECT f.param_id, f.chrom, f.a, f.b, s.start, s.stop, u.*, least(s.stop - s.start, u.settled) AS n,
               unnest(range(1, least(s.stop - s.start, u.settled) + 1)) AS k
        FROM v_filter f JOIN v_run s ON f.chrom = s.chrom AND s.run = f.run + 1
        JOIN v_update u ON u.param_id = f.param_id AND u.x = s.x)
  UNION ALL
  SELECT f.param_id, f.chrom, s.start, s.stop, s.x, CASE WHEN f.b - f.a > 1e-12 THEN 1 ELSE 0 END
  FROM v_filter f JOIN v_run s ON f.chrom = s.chrom AND f.run = s.run WHERE s.run = 0""")
fragment("v_stretch", """
  SELECT i.param_id, i.chrom, min(start) AS start, max(stop) AS "end", CAST(sum(x * (stop - start)) AS BIGINT) AS num_conserved,
         min(start) > 0 AS opened, max(stop) < max(l.length) AS closed
  FROM (SELECT *, sum(changed) OVER (PARTITION BY param_id, chrom ORDER BY start) AS isl
        FROM (SELECT *, CASE WHEN state = lag(state) OVER (PARTITION BY param_id, chrom ORDER BY start) THEN 0 ELSE 1 END AS changed
              FROM v_piece)) i
  JOIN v_chromes l ON i.chrom = l.chrom WHERE state = 1 GROUP BY i.param_id, i.chrom, isl""")
fragment("v_class", f"""
  SELECT *, "end" - start AS len, CASE WHEN "end" - start <= {MIN_LEN} THEN 'short' WHEN "end" - start >= {MAX_LEN} THEN 'long'
         ELSE 'kept' END AS length_class FROM v_stretch""")


def _stretches(spark, d):
    return segment.hmm_segment(*_bases(spark, d), PARAMS)


@query("hmm_stretches", 'SELECT param_id, chrom, start, "end", num_conserved, opened, closed FROM v_stretch')
def hmm_stretches(spark, d):
    return _stretches(spark, d)


@query("hmm_elements", """
  SELECT param_id, chrom, start, "end", num_conserved, len AS length, length_class, round(num_conserved / len, 6) AS density
  FROM v_class WHERE opened AND closed""")
def hmm_elements(spark, d):
    out = segment.hmm_elements(_stretches(spark, d), MIN_LEN, MAX_LEN)
    return out.withColumn("density", F.round("density", 6))


fragment("v_kept", """
  SELECT *, start - lag("end") OVER (PARTITION BY param_id, chrom ORDER BY start) AS gap
  FROM v_class WHERE opened AND closed AND length_class = 'kept'""")


SUMMARY_SQL = f"""
  SELECT p.param_id, l.chrom, l.length, c.n AS conserved_sites, coalesce(e.total, 0) AS total_elements,
         coalesce(e.short, 0) AS too_short, coalesce(e.long, 0) AS too_long,
         coalesce(e.total - e.short - e.long, 0) AS final_elements,
         coalesce(round(k.len / nullif(e.total - e.short - e.long, 0), 6), 0) AS mean_length,
         coalesce(round(k.gap / nullif(e.total - e.short - e.long, 0), 6), 0) AS mean_gap,
         CAST(coalesce(k.cons, 0) AS BIGINT) AS sites_in_elements,
         coalesce(round(k.dens / nullif(e.total - e.short - e.long, 0), 6), 0) AS mean_density,
         p.t0 AS t0_0, p.t1 AS t1_1, p.e0 AS e0_0, p.e1 AS e1_1, p.s0, {MIN_LEN} AS min_len
  FROM v_par p CROSS JOIN v_chromes l JOIN (SELECT chrom, count(*) AS n FROM v_cpos GROUP BY chrom) c ON l.chrom = c.chrom
  LEFT JOIN (SELECT param_id, chrom, count(*) FILTER (opened) AS total,
                    count(*) FILTER (opened AND closed AND length_class = 'short') AS short,
                    count(*) FILTER (opened AND closed AND length_class = 'long') AS long
             FROM v_class GROUP BY ALL) e ON e.param_id = p.param_id AND e.chrom = l.chrom
  LEFT JOIN (SELECT param_id, chrom, sum(len) AS len, coalesce(sum(gap), 0) AS gap, sum(num_conserved) AS cons,
                    sum(num_conserved / len) AS dens FROM v_kept GROUP BY ALL) k
  ON k.param_id = p.param_id AND k.chrom = l.chrom"""


@query("hmm_summary", SUMMARY_SQL)
def hmm_summary(spark, d):
    cons, lengths = _bases(spark, d)
    out = segment.hmm_summary(segment.hmm_segment(cons, lengths, PARAMS), cons, lengths, PARAMS, MIN_LEN, MAX_LEN)
    for c in ("mean_length", "mean_gap", "mean_density"):
        out = out.withColumn(c, F.round(c, 6))
    return as_long(out, "sites_in_elements")


@query("hmm_states", """
  SELECT s.*, coalesce(b.n, 0) AS starts, CAST(coalesce(b.at, 0) AS BIGINT) AS start_positions, coalesce(e.n, 0) AS ends,
         CAST(coalesce(e.starts, 0) AS BIGINT) AS elem_starts, CAST(coalesce(e.bases, 0) AS BIGINT) AS elem_bases,
         coalesce(round(e.density, 4), 0) AS elem_density
  FROM (SELECT param_id, chrom, pos // 3600 AS hour, count(*) AS bases, CAST(sum(x) AS BIGINT) AS conserved,
               CAST(sum(state) AS BIGINT) AS inside, CAST(sum(state * pos) AS BIGINT) AS inside_positions
        FROM (SELECT param_id, chrom, unnest(range(start, stop)) AS pos, x, state FROM v_piece) GROUP BY ALL) s
  LEFT JOIN (SELECT param_id, chrom, start // 3600 AS hour, count(*) AS n, sum(start) AS at FROM v_class WHERE start > 0 GROUP BY ALL) b
  USING (param_id, chrom, hour)
  LEFT JOIN (SELECT param_id, chrom, "end" // 3600 AS hour, count(*) AS n, sum(start) AS starts, sum(len) AS bases,
                    sum(CASE WHEN length_class = 'kept' THEN num_conserved / len END) AS density
             FROM v_class WHERE opened AND closed GROUP BY ALL) e USING (param_id, chrom, hour)""")
def hmm_states(spark, d):
    """The state of every base, added up by hour: the rows themselves are as many as the genome's bases."""
    cons, lengths = _bases(spark, d)
    stretches = cut(segment.hmm_segment(cons, lengths, PARAMS))
    rows = segment.state_sequence(stretches, cons, lengths, [p.param_id for p in PARAMS], MIN_LEN, MAX_LEN)
    start, end = F.col("change") == "START", F.col("change") == "END"
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return rows.groupBy("param_id", "chrom", F.floor(F.col("pos") / 3600).alias("hour")).agg(
        F.count(F.lit(1)).alias("bases"), whole("symbol").alias("conserved"), whole((F.col("place") == "IN").cast("int")).alias("inside"),
        whole(F.col("state") * F.col("pos")).alias("inside_positions"), F.count(F.when(start, 1)).alias("starts"),
        whole(F.when(start, F.col("pos"))).alias("start_positions"), F.count(F.when(end, 1)).alias("ends"),
        whole(F.when(end, F.col("elem_start"))).alias("elem_starts"), whole(F.when(end, F.col("elem_length"))).alias("elem_bases"),
        F.round(F.coalesce(F.sum("elem_density"), F.lit(0.0)), 4).alias("elem_density"))


@query("hmm_elements_bases")
def hmm_elements_bases(spark, d):
    """The same segmentation on single positions of every chromosome."""
    cons = cut(pipelines.conserved(A.sites(spark, d)))
    sets = [HmmParams(0, 0.9999, 0.999, 0.9998, 0.01, 0.9)]
    return segment.hmm_elements(segment.hmm_segment(cons, A.chromes(spark, d), sets), 20, 10**9)


@query("hmm_stretches_bases", 'SELECT param_id, chrom, start, "end", num_conserved, opened, closed FROM v_stretch')
def hmm_stretches_bases(spark, d):
    """Former name of ``hmm_stretches``."""
    return _stretches(spark, d)


@query("hmm_elements_all_bases", """
  SELECT param_id, chrom, start, "end", num_conserved, len AS length, length_class, num_conserved / len AS density
  FROM v_class WHERE opened AND closed""")
def hmm_elements_all_bases(spark, d):
    """``hmm_elements`` with the unrounded density."""
    return segment.hmm_elements(segment.hmm_segment(*_bases(spark, d), PARAMS), MIN_LEN, MAX_LEN)


@query("hmm_summary_bases", SUMMARY_SQL)
def hmm_summary_bases(spark, d):
    """``hmm_summary`` by the fold that serves grids."""
    out = segment.hmm_grid_summary(*_bases(spark, d), PARAMS, MIN_LEN, MAX_LEN)
    for c in ("mean_length", "mean_gap", "mean_density"):
        out = out.withColumn(c, F.round(c, 6))
    return out


GRID = [HmmParams(i, t0, t1, e0, e1, 1.0) for i, (t0, t1, e0, e1) in enumerate(
    (t0, t1, e0, e1) for t0 in (0.5, 0.8, 0.9) for t1 in (0.5, 0.8, 0.9) for e0 in (0.6, 0.8) for e1 in (0.3, 0.8))]


#: The same texts over the grid: every fragment that depends on the parameter sets under a second name.
BY_SET = ("v_par", "v_update", "v_filter", "v_piece", "v_stretch", "v_class", "v_kept")


def _over_grid(sql: str) -> str:
    return re.sub(rf"\b({'|'.join(BY_SET)})\b", r"\1_grid", sql)


fragment("v_par_grid", _sets_sql(GRID))
for _name in BY_SET[1:]:
    fragment(f"{_name}_grid", _over_grid(FRAGMENTS[_name]))
fragment("v_summary_grid", _over_grid(SUMMARY_SQL))


@query("hmm_grid", """
  SELECT *, round(t0_0 / t1_1, 6) AS t_ratio, round(t0_0 - t1_1, 6) AS t_diff, round(t0_0 * t1_1, 6) AS t_prod,
         CAST(t0_0 AS VARCHAR) || '-' || CAST(t1_1 AS VARCHAR) AS t_key,
         round(e0_0 / e1_1, 6) AS e_ratio, round(e0_0 - e1_1, 6) AS e_diff, round(e0_0 * e1_1, 6) AS e_prod,
         CAST(e0_0 AS VARCHAR) || '-' || CAST(e1_1 AS VARCHAR) AS e_key,
         round(CASE WHEN conserved_sites > 0 THEN sites_in_elements / conserved_sites END, 6) AS share_in_elements
  FROM v_summary_grid""")
def hmm_grid(spark, d):
    """Summary of a whole parameter grid with the derived grid columns."""
    out = grid.hmm_grid_features(segment.hmm_grid_summary(*_bases(spark, d), GRID, MIN_LEN, MAX_LEN))
    for c in ("mean_length", "mean_gap", "mean_density", "t_ratio", "t_diff", "t_prod", "e_ratio", "e_diff", "e_prod", "share_in_elements"):
        out = out.withColumn(c, F.round(c, 6))
    return as_long(out, "sites_in_elements")


#: The full grid: 0.1 to 0.9 for each of the four.
FULL_GRID = [HmmParams(i, t0 / 10, t1 / 10, e0 / 10, e1 / 10, 1.0)
             for i, (t0, t1, e0, e1) in enumerate(product(range(1, 10), repeat=4))]


@query("hmm_grid_bases")
def hmm_grid_bases(spark, d):
    """``hmm_grid`` over all 6,561 sets of the full grid."""
    return grid.hmm_grid_features(segment.hmm_grid_summary(*_bases(spark, d), FULL_GRID, MIN_LEN, MAX_LEN))


@query("hmm_grid_limits", """
  SELECT param_id, chrom, final_elements, mean_length, mean_gap FROM v_summary_grid
  WHERE mean_length < 8 AND mean_gap < 40 AND final_elements < 100000""")
def hmm_grid_limits(spark, d):
    report = hmm_grid(spark, d).select("param_id", "chrom", "final_elements", "mean_length", "mean_gap")
    return grid.grid_below(report, mean_length=8, mean_gap=40, final_elements=100000)


@query("grid_features", """
  SELECT o_orderkey, round(t0_0 / t1_1, 6) AS t_ratio, round(t0_0 - t1_1, 6) AS t_diff, round(t0_0 * t1_1, 6) AS t_prod,
         CAST(t0_0 AS VARCHAR) || '-' || CAST(t1_1 AS VARCHAR) AS t_key, round(t1_1 / t0_0, 6) AS e_ratio,
         round(CASE WHEN cs > 0 THEN se / cs END, 6) AS share_in_elements
  FROM (SELECT o_orderkey, (o_custkey % 9 + 1) / 10 AS t0_0, (o_orderkey % 9 + 1) / 10 AS t1_1, o_custkey AS cs,
               o_custkey % 50 AS se FROM orders) WHERE t0_0 = 0.5""")
def grid_features(spark, d):
    o = A.table(spark, d, "orders")
    t0, t1 = (F.col("o_custkey") % 9 + 1) / 10, (F.col("o_orderkey") % 9 + 1) / 10
    report = o.select("o_orderkey", t0.alias("t0_0"), t1.alias("t1_1"), t1.alias("e0_0"), t0.alias("e1_1"),
                      F.col("o_custkey").alias("conserved_sites"), (F.col("o_custkey") % 50).alias("sites_in_elements"))
    out = grid.grid_slice(grid.hmm_grid_features(report), t0_0=0.5)
    return out.select("o_orderkey", r6("t_ratio", "t_ratio"), r6("t_diff", "t_diff"), r6("t_prod", "t_prod"), "t_key",
                      r6("e_ratio", "e_ratio"), r6("share_in_elements", "share_in_elements"))


@query("chromosome_grid", """
  SELECT chrom, length, size AS min_cluster_size, m AS min_samples
  FROM v_chromes, (SELECT unnest([5, 10, 50]) AS size), (SELECT unnest([3, 25]) AS m)""")
def chromosome_grid(spark, d):
    sets = [{"min_cluster_size": s, "min_samples": m} for s in (5, 10, 50) for m in (3, 25)]
    return grid.grid_over(A.chromes(spark, d), sets)


@query("acceleration_classes", """
  SELECT p_partkey, logbf1 > 5 AS above_bf1, logbf2 > 5 AS above_bf2,
         CASE WHEN logbf1 > 5 AND logbf2 > 5 THEN 'Accelerated' ELSE 'Not accelerated' END AS accelerated,
         logbf1 < 200 AND logbf2 > -500 AS displayed
  FROM (SELECT p_partkey, p_size - 25 AS logbf1, p_retailprice - 950 AS logbf2 FROM part)""")
def acceleration_classes(spark, d):
    return grid.classify_acceleration(A.elem_lik(spark, d)).drop("logbf1", "logbf2")


@query("bayes_factor_grid", """
  SELECT CAST(a.v AS INTEGER) AS bf1, CAST(b.v AS INTEGER) AS bf2, count(p.p_partkey) AS n_above
  FROM (SELECT unnest(range(-20, 21)) AS v) a CROSS JOIN (SELECT unnest(range(-20, 21)) AS v) b
  LEFT JOIN part p ON p.p_size - 25 > a.v AND p.p_retailprice - 950 > b.v GROUP BY 1, 2""")
def bayes_factor_grid(spark, d):
    return grid.grid_exceedance(A.elem_lik(spark, d))
