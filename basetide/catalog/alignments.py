"""Alignment queries: depth, blocks, patterns, region extraction, de-duplication, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from basetide import adapters as A
from basetide.catalog.common import fragment, query, r6
from basetide.functions import sequences as S
from basetide.operators import alignment, intervals, patterns, sites
from basetide.sources.readers import gff_chromosomes, gff_for_chrom

fragment("v_docs", """
  SELECT doc_id // 4 AS g, doc_id % 4 AS s, 'ctg' || (doc_id // 4) AS chrom, text, length(text) AS len FROM documents""")
fragment("v_contig", "SELECT g, chrom, CAST(max(len) AS BIGINT) AS length FROM v_docs GROUP BY g, chrom")
fragment("v_chars", """
  SELECT g, s, chrom, len, unnest(range(len)) AS pos, unnest(regexp_extract_all(text, '(?s).')) AS ch FROM v_docs""")
fragment("v_coldepth", """
  SELECT chrom, pos, count(*) FILTER (ch NOT IN ('-', 'n', 'N')) AS depth FROM v_chars GROUP BY chrom, pos""")
fragment("v_cols", """
  SELECT k.g, k.chrom, k.pos,
         string_agg(coalesce(c.ch, CASE WHEN d.len > k.pos // 60 * 60 THEN '-' ELSE '*' END), '' ORDER BY k.s) AS pattern
  FROM (SELECT g, chrom, pos, s FROM (SELECT g, chrom, unnest(range(length)) AS pos FROM v_contig),
        (SELECT unnest([0, 1, 2, 3]) AS s)) k
  LEFT JOIN v_chars c ON k.g = c.g AND k.s = c.s AND k.pos = c.pos
  LEFT JOIN v_docs d ON k.g = d.g AND k.s = d.s
  GROUP BY k.g, k.chrom, k.pos""")
fragment("v_pat", """
  SELECT row_number() OVER (ORDER BY md5(pattern), pattern) - 1 AS idx, pattern, n
  FROM (SELECT pattern, count(*) AS n FROM v_cols GROUP BY pattern)""")
fragment("v_blocks", """
  SELECT c.chrom, b.j * 60 AS start, least(60, c.length - b.j * 60) AS size, c.g, b.j
  FROM (SELECT g, chrom, length, unnest(range((length + 59) // 60)) AS j FROM v_contig) b JOIN v_contig c USING (g)""")


@query("alignment_depth", """
  SELECT chrom, min(pos) AS start, max(pos) + 1 AS "end", CAST(depth AS INTEGER) AS depth
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY chrom, pos // 60, depth ORDER BY pos) AS isl FROM v_coldepth)
  GROUP BY chrom, pos // 60, depth, isl""")
def alignment_depth(spark, d):
    return alignment.maf_depth(A.blocks(spark, d))


@query("alignment_depth_packed", """
  SELECT chrom, min(pos) AS start, max(pos) + 1 AS "end", CAST(depth AS INTEGER) AS depth
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY chrom, depth ORDER BY pos) AS isl FROM v_coldepth)
  GROUP BY chrom, depth, isl""")
def alignment_depth_packed(spark, d):
    return alignment.packed_depth(A.blocks(spark, d))


@query("alignment_depth_counts", """
  SELECT chrom, CAST(depth AS INTEGER) AS depth, count(*) AS n FROM v_coldepth GROUP BY ALL""")
def alignment_depth_counts(spark, d):
    return sites.depth_histogram(alignment.maf_depth(A.blocks(spark, d)))


@query("block_summary", """
  SELECT b.g * 1000000 + b.j AS block_id, b.chrom AS ref_scaffold, b.start AS ref_start, b.size AS aln_len,
         CAST(b.size AS INTEGER) AS line_len, CAST(count(*) AS INTEGER) AS n_seqs
  FROM v_blocks b JOIN v_docs d ON b.g = d.g AND d.len > b.start GROUP BY ALL""")
def block_summary(spark, d):
    return alignment.block_summary(A.blocks(spark, d))


@query("block_composition", """
  SELECT species, blocks, bases, n_a, n_c, n_g, n_t,
         round((n_c + n_g) / (n_a + n_c + n_g + n_t), 6) AS gc
  FROM (SELECT 'sp' || s AS species, CAST(sum((len + 59) // 60) AS BIGINT) AS blocks,
               CAST(sum(len - (length(text) - length(replace(text, '-', '')))) AS BIGINT) AS bases,
               CAST(sum(len - length(replace(upper(text), 'A', ''))) AS BIGINT) AS n_a,
               CAST(sum(len - length(replace(upper(text), 'C', ''))) AS BIGINT) AS n_c,
               CAST(sum(len - length(replace(upper(text), 'G', ''))) AS BIGINT) AS n_g,
               CAST(sum(len - length(replace(upper(text), 'T', ''))) AS BIGINT) AS n_t FROM v_docs GROUP BY s)""")
def block_composition(spark, d):
    out = alignment.block_composition(A.blocks(spark, d))
    return out.withColumn("gc", F.round("gc", 6))


@query("species_subset", """
  SELECT chrom, 'sp' || s AS species, count(*) AS n_rows
  FROM (SELECT chrom, s, unnest(range((len + 59) // 60)) AS j FROM v_docs WHERE s IN (1, 3)) GROUP BY ALL""")
def species_subset(spark, d):
    kept = alignment.subset_species(A.blocks(spark, d), ["sp1", "sp3"])
    return (kept.select("chrom", F.explode("rows.species").alias("species"))
            .groupBy("chrom", "species").agg(F.count(F.lit(1)).alias("n_rows")))


@query("site_patterns", "SELECT idx, pattern, n FROM v_pat")
def site_patterns(spark, d):
    return patterns.site_patterns(patterns.block_columns(A.blocks(spark, d), A.SPECIES))


@query("pattern_header", """
  SELECT unnest(['NSEQS', 'LENGTH', 'NTUPLES']) AS key,
         unnest([CAST(max(length(pattern)) AS VARCHAR), CAST(sum(n) AS VARCHAR), CAST(count(*) AS VARCHAR)]) AS value
  FROM v_pat""")
def pattern_header(spark, d):
    return patterns.pattern_header(site_patterns(spark, d))


@query("pattern_union", """
  SELECT row_number() OVER (ORDER BY md5(pattern), pattern) - 1 AS idx, pattern, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT pattern, n FROM v_pat UNION ALL SELECT reverse(pattern), n FROM v_pat) GROUP BY pattern""")
def pattern_union(spark, d):
    one = site_patterns(spark, d).select("pattern", "n")
    return patterns.site_patterns(sites.union_all([one, one.select(F.reverse("pattern").alias("pattern"), "n")]))


fragment("v_marked", """
  SELECT *, (4 - length(replace(pattern, '*', ''))) * n AS missing,
         (4 - length(replace(pattern, '*', ''))) * n <= round_even(4 * 0.625, 0) AS kept FROM v_pat""")


@query("filtered_patterns", """
  SELECT row_number() OVER (ORDER BY idx) - 1 AS idx, pattern, n FROM v_marked WHERE kept""")
def filtered_patterns(spark, d):
    return patterns.filter_patterns(site_patterns(spark, d), 4, 0.625)


def _summary_sql() -> str:
    """The eight statistics before and after filtering, as one UNION."""
    parts = []
    for cat, cond in (("pre", "true"), ("post", "kept")):
        seqs = "max(4)" if cat == "pre" else " + ".join(
            f"max(CASE WHEN substr(pattern, {i}, 1) <> '*' THEN 1 ELSE 0 END)" for i in range(1, 5))
        for var, expr in (("num.seqs", seqs), ("aln.len", "sum(n)"), ("num.sites", "count(*)"),
                          ("avg.site.count", "sum(n) / count(*)"), ("max.site.count", "max(n)"),
                          ("num.singletons", "count(*) FILTER (n = 1)"), ("total.missing.cols", "sum(missing)"),
                          ("avg.missing.per.site", "sum(missing) / sum(n)")):
            parts.append(f"SELECT '{var}' AS var, '{cat}.filter' AS filter_cat, "
                         f"round(CAST({expr} AS DOUBLE), 6) AS value FROM v_marked WHERE {cond}")
    return " UNION ALL ".join(parts)


@query("pattern_filter_summary", _summary_sql())
def pattern_filter_summary(spark, d):
    out = patterns.pattern_summary(site_patterns(spark, d), 4, 0.625)
    return out.withColumn("value", F.round("value", 6))


@query("species_presence", """
  SELECT CAST(s AS INTEGER) AS species_no, count(*) FILTER (substr(pattern, s + 1, 1) <> '*') AS n_present
  FROM v_marked, (SELECT unnest([0, 1, 2, 3]) AS s) WHERE kept GROUP BY s""")
def species_presence(spark, d):
    return patterns.species_presence(patterns.mark_patterns(site_patterns(spark, d), 4, 0.625), 4)


# every contig is one coding feature; odd contigs lie on the reverse strand
def _features(spark, d):
    no = F.regexp_extract("chrom", r"(\d+)", 1).cast("long")
    c = A.contigs(spark, d).withColumn("no", no)
    return c.select(
        F.lit(None).cast("string").alias("pragma"), F.col("chrom").alias("seqid"), F.lit("docs").alias("source"),
        F.lit("CDS").alias("type"), F.lit(1).cast("long").alias("start"), F.col("length").alias("end"),
        F.when(F.col("no") % 2 == 0, "+").otherwise("-").alias("strand"), (F.col("no") % 3).cast("string").alias("phase"))


ACGT_SQL = "translate(lower({}), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"
fragment("v_refch", f"""
  SELECT c.g, c.chrom, c.pos, c.len, {ACGT_SQL.format("c.ch")} AS ch, translate({ACGT_SQL.format("c.ch")}, 'ACGT', 'TGCA') AS rc
  FROM v_chars c JOIN (SELECT g, arg_min(s, -len * 4 + s) AS s FROM v_docs GROUP BY g) r ON c.g = r.g AND c.s = r.s""")
fragment("v_third", """
  SELECT g, chrom, pos FROM (
    SELECT *, g % 3 AS ph, lag(ch, 2) OVER w || lag(ch, 1) OVER w AS ahead, lead(rc, 2) OVER w || lead(rc, 1) OVER w AS back
    FROM v_refch WINDOW w AS (PARTITION BY g ORDER BY pos))
  WHERE CASE WHEN g % 2 = 0
             THEN pos >= ph + 2 AND (pos - ph) % 3 = 2
                  AND ahead IN ('AC', 'CC', 'CG', 'CT', 'GC', 'GG', 'GT', 'TC')
             ELSE pos <= len - 3 - ph AND (len - 1 - ph - pos) % 3 = 2
                  AND back IN ('AC', 'CC', 'CG', 'CT', 'GC', 'GG', 'GT', 'TC') END""")


@query("fourfold_columns", f"""
  SELECT t.chrom, t.pos, {ACGT_SQL.format("c.pattern")} AS pattern FROM v_third t JOIN v_cols c ON t.g = c.g AND t.pos = c.pos""")
def fourfold_columns(spark, d):
    return patterns.fourfold_columns(A.blocks(spark, d, acgt=True), _features(spark, d), A.SPECIES, A.block_spans(spark, d, acgt=True))


@query("feature_subset", """
  SELECT 'ref.' || chrom AS seqid, CAST(1 AS BIGINT) AS start, length AS "end" FROM v_contig WHERE chrom = 'ctg7'""")
def feature_subset(spark, d):
    return gff_for_chrom(_features(spark, d), "ctg7", "ref.").select("seqid", "start", "end")


@query("chromosome_features", "SELECT chrom AS seqid, length AS \"end\" FROM v_contig WHERE g % 2 = 0")
def chromosome_features(spark, d):
    kind = F.when(F.col("strand") == "+", "whole chromosome").otherwise("CDS")
    return gff_chromosomes(_features(spark, d).withColumn("type", kind)).select("seqid", "end")


def _regions(spark, d):
    return intervals.make_windows(A.contigs(spark, d), 250)


fragment("v_regions", """
  SELECT g, chrom, w * 250 AS start, least(w * 250 + 250, length) AS "end"
  FROM (SELECT *, unnest(range((length + 249) // 250)) AS w FROM v_contig)""")
fragment("v_fetched", """
  SELECT 'doc-' || r.chrom || '-' || r.start || '-' || r."end" AS region_id, r.chrom, r.start, r."end",
         'sp' || d.s AS species, rpad(substr(d.text, r.start + 1, r."end" - r.start), CAST(r."end" - r.start AS INTEGER), '-') AS seq
  FROM v_regions r JOIN v_docs d ON r.g = d.g AND d.len > r.start // 60 * 60""")


@query("fetched_regions", """
  SELECT region_id, species, start AS src_start, start + length(replace(seq, '-', '')) AS src_end, seq FROM v_fetched""")
def fetched_regions(spark, d):
    out = alignment.fetch_regions(A.blocks(spark, d), _regions(spark, d), ref="doc", bin_width=240, spans=A.block_spans(spark, d))
    return out.select("region_id", "species", "src_start", "src_end", "seq")


@query("long_features", """
  SELECT region_id, species, seq FROM v_fetched WHERE "end" - start >= 200""")
def long_features(spark, d):
    regions = _regions(spark, d).where(F.col("end") - F.col("start") >= 200)
    return alignment.fetch_regions(A.blocks(spark, d), regions, ref="doc", bin_width=240, spans=A.block_spans(spark, d)).select(
        "region_id", "species", "seq")


# two of three windows are features, so groups run over holes; the shortest pieces have 10 columns
fragment("v_piece", """
  SELECT g, chrom, start, "end", "end" - start AS len, row_number() OVER (PARTITION BY g ORDER BY start) AS no
  FROM (SELECT r.g, r.chrom, greatest(r.start, b.start) AS start, least(r."end", b.start + b.size) AS "end"
        FROM v_regions r JOIN v_blocks b ON r.g = b.g AND r.start < b.start + b.size AND b.start < r."end"
        WHERE r.start // 250 % 3 <> 1)""")
fragment("v_group", """
  SELECT g, no, 1 AS group_no, len AS acc FROM v_piece WHERE no = 1
  UNION ALL
  SELECT p.g, p.no, CASE WHEN q.acc >= 200 THEN q.group_no + 1 ELSE q.group_no END, CASE WHEN q.acc >= 200 THEN 0 ELSE q.acc END + p.len
  FROM v_group q JOIN v_piece p ON p.g = q.g AND p.no = q.no + 1""")


@query("concatenated_blocks", """
  SELECT p.chrom, CAST(o.group_no AS BIGINT) AS group_no, min(p.start) AS start, max(p."end") AS "end",
         CAST(count(*) AS INTEGER) AS n_pieces, CAST(sum(p.len) AS INTEGER) AS width, 'sp' || d.s AS species,
         string_agg(rpad(substr(d.text, p.start + 1, p.len), CAST(p.len AS INTEGER), '-'), '' ORDER BY p.start) AS seq
  FROM v_piece p JOIN v_group o ON p.g = o.g AND p.no = o.no JOIN v_docs d ON p.g = d.g
  GROUP BY p.chrom, o.group_no, d.s HAVING bool_or(d.len > p.start // 60 * 60)""")
def concatenated_blocks(spark, d):
    features = _regions(spark, d).where(F.floor(F.col("start") / 250) % 3 != 1)
    out = alignment.concat_blocks(A.blocks(spark, d), features, 200, tile_width=1024, spans=A.block_spans(spark, d))
    return out.select("chrom", "group_no", "start", "end", "n_pieces", "width", F.explode("rows").alias("r")).select(
        "chrom", "group_no", "start", "end", "n_pieces", "width", "r.species", F.col("r.text").alias("seq"))


@query("region_loci", """
  SELECT (idx // 20) + 1 AS batch_id, idx, CAST(sum(len) OVER w - len AS BIGINT) AS start,
         CAST(sum(len) OVER w AS BIGINT) AS "end", name
  FROM (SELECT row_number() OVER (ORDER BY chrom, start, region_id) - 1 AS idx, "end" - start AS len, region_id AS name
        FROM (SELECT region_id, chrom, start, "end" FROM v_fetched GROUP BY ALL HAVING count(*) = 4))
  WINDOW w AS (PARTITION BY idx // 20 ORDER BY idx ROWS UNBOUNDED PRECEDING)""")
def region_loci(spark, d):
    from basetide.plans.pipelines import element_loci

    regions = _regions(spark, d)
    return element_loci(A.blocks(spark, d), regions, 4, ref="doc", spans=A.block_spans(spark, d))[1]


fragment("v_aln", """
  SELECT l_orderkey AS region_id, 'sp' || (l_suppkey % 5) AS species, l_linenumber AS line, l_partkey AS part,
         CAST(l_quantity AS INTEGER) AS gaps FROM lineitem""")
fragment("v_dedup", """
  SELECT region_id, species, line, part, gaps FROM (
    SELECT *, row_number() OVER (PARTITION BY region_id, species ORDER BY gaps, line, part) AS rn FROM v_aln) WHERE rn = 1""")
fragment("v_complete", """
  SELECT * FROM v_dedup WHERE region_id IN (SELECT region_id FROM v_dedup GROUP BY region_id HAVING count(*) = 4)""")


def _dedup(spark, d):
    return alignment.dedup_species(A.alignments(spark, d), order=("line", "part"))


@query("dedup_alignments", "SELECT region_id, species, line, part, gaps FROM v_dedup")
def dedup_alignments(spark, d):
    return _dedup(spark, d).select("region_id", "species", "line", "part", S.gap_count("seq").alias("gaps"))


@query("complete_alignments", "SELECT region_id, species, gaps FROM v_complete")
def complete_alignments(spark, d):
    return alignment.complete_regions(_dedup(spark, d), 4).select("region_id", "species", S.gap_count("seq").alias("gaps"))


@query("seqs_per_alignment", """
  SELECT n_seqs, count(*) AS n_alignments FROM (SELECT count(*) AS n_seqs FROM v_complete GROUP BY region_id) GROUP BY 1""")
def seqs_per_alignment(spark, d):
    return alignment.seqs_per_alignment(alignment.complete_regions(_dedup(spark, d), 4))


@query("pruned_alignments", """
  SELECT l_orderkey AS region_id, l_suppkey AS species, count(*) AS n FROM lineitem
  WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) GROUP BY ALL""")
def pruned_alignments(spark, d):
    aln = A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("region_id"), F.col("l_suppkey").alias("species"))
    prune = A.table(spark, d, "supplier").where(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("species"))
    return sites.count_by(alignment.prune_species(aln, prune), "region_id", "species")


CHUNK = 1000
fragment("v_gwin", """
  SELECT page_id, html, CAST(page_id AS VARCHAR) AS chrom, w * 700 AS start,
         least(w * 700 + 700, length(html)) AS "end"
  FROM (SELECT *, unnest(range((length(html) + 699) // 700)) AS w FROM pages)""")


def _genome_windows(spark, d):
    lengths = A.genome(spark, d).select(F.col("title").alias("chrom"), F.length("seq").cast("long").alias("length"))
    return intervals.make_windows(lengths, 700).select("chrom", "start", "end")


@query("genome_slices", """
  SELECT chrom, start, "end", substr(html, start + 1, "end" - start) AS genome_seq FROM v_gwin""")
def genome_slices(spark, d):
    chunks = alignment.chunk_genome(A.genome(spark, d), CHUNK)
    return alignment.genome_slice(_genome_windows(spark, d), chunks, CHUNK)


@query("reference_check", """
  SELECT matches, count(*) AS n FROM (
    SELECT upper(substr(html, start + 1, "end" - start)) = upper(replace(lower(substr(html, start + 1, "end" - start)), 'q', 'x'))
           AS matches FROM v_gwin) GROUP BY 1""")
def reference_check(spark, d):
    chunks = alignment.chunk_genome(A.genome(spark, d), CHUNK)
    ref = alignment.genome_slice(_genome_windows(spark, d), chunks, CHUNK)
    aln = ref.select("chrom", "start", "end", F.lit("ref").alias("species"),
                     F.replace(F.lower("genome_seq"), F.lit("q"), F.lit("x")).alias("seq"))
    checked = alignment.validate_reference(aln, chunks, "ref", CHUNK)
    return sites.count_by(checked, "matches")


@query("sequence_functions", """
  SELECT doc_id, len - length(replace(text, '*', '')) AS stars, len - length(replace(text, '-', '')) AS gaps,
         length(replace(text, '-', '')) AS ungapped, length(regexp_replace(text, '[-nN]', '', 'g')) AS informative,
         substr(text, 11, 20) AS piece, repeat('-', len % 7) AS pad
  FROM (SELECT doc_id, text, CAST(length(text) AS INTEGER) AS len FROM documents)""")
def sequence_functions(spark, d):
    docs = A.table(spark, d, "documents")
    return docs.select("doc_id", S.count_char("text", "*").cast("long").alias("stars"), S.gap_count("text").cast("long").alias("gaps"),
                       S.ungapped_length("text").cast("long").alias("ungapped"),
                       S.informative_length("text").cast("long").alias("informative"),
                       S.slice_seq("text", 10, 30).alias("piece"), S.pad_gaps(F.length("text") % 7).alias("pad"))


@query("transposed_blocks", """
  SELECT chrom, start, string_agg(coalesce(c, '-'), '' ORDER BY s) AS column_text, pos - start AS offset_in_block
  FROM (SELECT k.chrom, k.pos // 60 * 60 AS start, k.pos, k.s, x.ch AS c
        FROM (SELECT p.g, p.chrom, p.pos, d.s FROM (SELECT g, chrom, unnest(range(length)) AS pos FROM v_contig) p
              JOIN v_docs d ON p.g = d.g AND d.len > p.pos // 60 * 60) k
        LEFT JOIN v_chars x ON k.g = x.g AND k.s = x.s AND k.pos = x.pos)
  GROUP BY chrom, start, pos""")
def transposed_blocks(spark, d):
    texts = F.transform(F.array_sort("rows"), lambda r: r["text"])
    cols = A.blocks(spark, d).select("chrom", "start", F.posexplode(S.columns_of(texts)).alias("k", "column_text"))
    return cols.select("chrom", "start", "column_text", F.col("k").cast("long").alias("offset_in_block"))


@query("region_names", """
  SELECT o_orderkey, 'ref' AS ref, 'chr' || o_orderpriority[1] AS chrom, o_custkey AS start, o_custkey + 200 AS "end"
  FROM orders""")
def region_names(spark, d):
    name = S.region_name("ref", F.concat(F.lit("chr"), F.substring("o_orderpriority", 1, 1)), F.col("o_custkey"),
                         F.col("o_custkey") + 200)
    full = F.concat(name, F.lit("-dedup.fa"))
    return A.table(spark, d, "orders").select("o_orderkey", S.parse_region_name(full).alias("r")).select("o_orderkey", "r.*")
