"""Text formats: tables are written in a format, the files are read back, and the rows are compared.

The files stand in the cluster's shared folder. White space inside texts becomes ``_``, as the formats separate by it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basetide import adapters as A
from basetide.catalog import alignments, segments, trees
from basetide.catalog.common import fragment, query, r6
from basetide.operators import alignment, intervals, patterns, sites
from basetide.plans.lineage import shared_path, written
from basetide.sources import readers, sinks

SPACES = r"[\x09-\x0D ]"
MARKED_SQL = r"regexp_replace({}, '[\x09-\x0D ]', '_', 'g')"


def _marked(col):
    return F.regexp_replace(col, SPACES, "_")


def _plain_blocks(spark, d):
    return A.blocks(spark, d).withColumn("rows", F.transform("rows", lambda r: r.withField("text", _marked(r["text"]))))


def _written(lines, name: str) -> str:
    path = shared_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


@query("bed_files", 'SELECT chrom, start, "end", part FROM v_iv')
def bed_files(spark, d):
    path = shared_path(spark, "bed")
    sinks.write_bed(A.intervals(spark, d), path, ["chrom", "start", "end", "part"])
    return readers.read_bed(spark, path, "part long")


@query("bedgraph_files", 'SELECT chrom, start, "end", score FROM v_sites')
def bedgraph_files(spark, d):
    path = shared_path(spark, "bedgraph")
    sinks.write_bed(A.sites(spark, d), path)
    return readers.read_bedgraph(spark, path)


@query("wig_files", """
  SELECT chrom, start, start + 1 AS "end", score
  FROM (SELECT chrom, score, start // 3600 * 7200
               + 2 * (row_number() OVER (PARTITION BY chrom, start // 3600 ORDER BY start) - 1) AS start FROM v_sites)""")
def wig_files(spark, d):
    """One fixedStep block per hour, its scores two bases apart."""
    hour = F.floor(F.col("start") / 3600)
    blocks = A.sites(spark, d).groupBy("chrom", hour.alias("hour")).agg(
        F.sort_array(F.collect_list(F.struct("start", "score"))).alias("s"))
    head = F.concat(F.lit("fixedStep chrom="), "chrom", F.lit(" start="), (F.col("hour") * 7200 + 1).cast("string"), F.lit(" step=2"))
    text = F.concat_ws("\n", head, F.transform("s", lambda x: x["score"].cast("string")))
    return readers.read_wig_fixedstep(spark, _written(blocks.select(text.alias("value")), "wig"))


@query("fai_files", """
  SELECT 'chr' || CASE WHEN page_id % 10 = 0 THEN 'scaffold' ELSE '' END || page_id AS chrom, length(html) AS length,
         CAST(CASE WHEN page_id % 10 = 0 THEN 2000 ELSE page_id END AS INTEGER) AS ord
  FROM pages WHERE html IS NOT NULL""")
def fai_files(spark, d):
    """Pages as chromosomes; every tenth has a name that is not a number."""
    name = F.concat(F.when(F.col("page_id") % 10 == 0, "scaffold").otherwise(""), F.col("page_id").cast("string"))
    lines = A.table(spark, d, "pages").where("html is not null").select(F.concat_ws(
        "\t", name, F.length("html").cast("string"), F.lit("0"), F.lit("60"), F.lit("61")).alias("value"))
    index = readers.read_fai(spark, _written(lines, "fai"), "chr")
    return index.select("chrom", "length", "ord")


@query("maf_files", f"""
  SELECT b.chrom, b.start, b.size, 'sp' || d.s AS species, b.chrom AS scaffold, b.start AS row_start,
         least(60, d.len - b.start) AS row_size, '+' AS strand, d.len AS src_size,
         {MARKED_SQL.format("rpad(substr(d.text, b.start + 1, 60), CAST(b.size AS INTEGER), '-')")} AS text
  FROM v_blocks b JOIN v_docs d ON b.g = d.g AND d.len > b.start""")
def maf_files(spark, d):
    path = _written(_plain_blocks(spark, d).select(sinks.maf_text().alias("value")), "maf")
    rows = readers.read_maf(spark, path).select("chrom", "start", "size", F.explode("rows").alias("r"))
    return rows.select("chrom", "start", "size", "r.species", "r.scaffold", F.col("r.start").alias("row_start"),
                       F.col("r.size").alias("row_size"), "r.strand", "r.src_size", "r.text")


@query("split_maf_blocks", """
  SELECT b.chrom, 'w' || (r.start // 250) AS win, b.start, count(*) AS n_rows
  FROM v_blocks b JOIN v_regions r ON b.g = r.g AND b.start < r."end" AND r.start < b.start + b.size
  JOIN v_docs d ON b.g = d.g AND d.len > b.start GROUP BY ALL""")
def split_maf_blocks(spark, d):
    """The blocks of every window; a block on a border belongs to both windows."""
    wins = intervals.make_windows(A.contigs(spark, d), 250).withColumn("win", F.concat(F.lit("w"), F.col("window_no").cast("string")))
    split = sinks.split_blocks(A.blocks(spark, d), wins)
    return split.select("chrom", "win", "start", F.size("rows").cast("long").alias("n_rows"))


@query("maf_partitions", f"""
  SELECT b.chrom AS in_chrom, 'w' || w AS in_win, b.start, 'sp' || d.s AS species,
         {MARKED_SQL.format("rpad(substr(d.text, b.start + 1, 60), CAST(b.size AS INTEGER), '-')")} AS text
  FROM (SELECT *, unnest(range(start // 20000, (start + size - 1) // 20000 + 1)) AS w FROM v_blocks) b
  JOIN v_docs d ON b.g = d.g AND d.len > b.start""")
def maf_partitions(spark, d):
    """The alignment in files of one chromosome and window of 20,000 bases and 100 blocks at most, kept as rows of a table, read back."""
    wins = intervals.make_windows(A.contigs(spark, d), 20000).withColumn("win", F.concat(F.lit("w"), F.col("window_no").cast("string")))
    path = shared_path(spark, "maf-split")
    sinks.write_maf_archive(_plain_blocks(spark, d), path, wins, 100, A.block_spans(spark, d))
    back = readers.read_maf_archive(spark, path)
    return back.select("in_chrom", "in_win", "start", F.explode("rows").alias("r")).select(
        "in_chrom", "in_win", "start", "r.species", "r.text")


@query("fasta_files", f"""
  SELECT region_id, chrom, start, "end", species, species || '.' || chrom || ':' || start || '-'
         || (start + length(replace(seq, '-', ''))) AS title, {MARKED_SQL.format("seq")} AS seq FROM v_fetched""")
def fasta_files(spark, d):
    regions = intervals.make_windows(A.contigs(spark, d), 250)
    aln = alignment.fetch_regions(_plain_blocks(spark, d), regions, ref="doc", bin_width=240, spans=A.block_spans(spark, d), ordered=True)
    path = shared_path(spark, "fasta")
    sinks.write_fasta_batches(aln, path, placed=True, compression="gzip")
    return readers.fasta_alignments(readers.read_fasta(spark, path, "part-*"), region_in_title=True)


@query("genome_files", """
  SELECT CAST(page_id AS VARCHAR) AS title, CAST(k AS BIGINT) AS chunk_no, substr(seq, k * 1000 + 1, 1000) AS seq
  FROM (SELECT *, unnest(range((length(seq) + 999) // 1000)) AS k
        FROM (SELECT page_id, regexp_replace(html, '[\\x09-\\x0D\\x1C-\\x1F\\x85\\p{Z}>]', '_', 'g') AS seq FROM pages))""")
def genome_files(spark, d):
    """Pages as chromosomes in lines of 60 letters, read back in pieces of 1,000."""
    seq = F.regexp_replace("html", r"[\x09-\x0D\x1C-\x1F\x85\p{Z}>]", "_")
    lines = F.concat_ws("\n", F.concat(F.lit(">"), F.col("page_id").cast("string")), F.regexp_extract_all(seq, F.lit("(?s).{1,60}"), F.lit(0)))
    path = _written(A.table(spark, d, "pages").select(lines.alias("value")), "genome")
    return readers.read_genome(spark, path, 1000, "part-*").select("title", "chunk_no", "seq")


@query("ss_files", f"""
  SELECT CAST(idx AS VARCHAR) AS key, {MARKED_SQL.format("pattern")} AS value, n FROM v_pat
  UNION ALL SELECT unnest(['NSEQS', 'LENGTH', 'NTUPLES']),
                   unnest([CAST(max(length(pattern)) AS VARCHAR), CAST(sum(n) AS VARCHAR), CAST(count(*) AS VARCHAR)]), NULL
            FROM v_pat""")
def ss_files(spark, d):
    """Header and patterns of a site-pattern file as one table."""
    found = alignments.site_patterns(spark, d)
    path = shared_path(spark, "ss")
    sinks.write_ss(patterns.pattern_header(found), found.withColumn("pattern", _marked("pattern")), path)
    header, again = readers.read_ss(spark, path)
    return again.select(F.col("idx").cast("string").alias("key"), F.col("pattern").alias("value"), "n").unionByName(
        header.withColumn("n", F.lit(None).cast("long")))


@query("gff_files", """
  SELECT NULL AS pragma, chrom AS seqid, 'docs' AS source, 'CDS' AS type, CAST(1 AS BIGINT) AS start, length AS "end", '.' AS score,
         CASE WHEN g % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(g % 3 AS VARCHAR) AS phase, 'ID=' || chrom AS attributes FROM v_contig
  UNION ALL SELECT '##sequence-region ' || chrom || ' 1 ' || length, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM v_contig""")
def gff_files(spark, d):
    """Every contig is a pragma line, a comment and a feature."""
    no = F.regexp_extract("chrom", r"(\d+)", 1).cast("long")
    feature = F.concat_ws("\t", "chrom", F.lit("docs"), F.lit("CDS"), F.lit("1"), F.col("length").cast("string"), F.lit("."),
                          F.when(no % 2 == 0, "+").otherwise("-"), (no % 3).cast("string"), F.concat(F.lit("ID="), "chrom"))
    pragma = F.concat_ws(" ", F.lit("##sequence-region"), "chrom", F.lit("1"), F.col("length").cast("string"))
    lines = A.contigs(spark, d).select(F.explode(F.array(pragma, F.concat(F.lit("# "), "chrom"), feature)).alias("value"))
    return readers.read_gff(spark, _written(lines, "gff"))


@query("count_files", """
  SELECT chrom, count(*) AS n, '0.05' AS alpha, '3' AS cutoff FROM v_depth WHERE depth >= 3 GROUP BY chrom
  UNION ALL SELECT chrom, count(*), '0.05', '10' FROM v_depth WHERE depth >= 10 GROUP BY chrom""")
def count_files(spark, d):
    """Sites per chromosome above two depths, one folder of counts for each."""
    counts = A.depth(spark, d).select("chrom", F.explode(F.filter(
        F.array(F.lit(3), F.lit(10)), lambda c: F.col("depth") >= c)).alias("c")).groupBy("chrom", "c").agg(F.count(F.lit(1)).alias("n"))
    path = shared_path(spark, "counts")
    (counts.select(F.concat(F.lit("sites.0.05."), F.col("c").cast("string"), F.lit(".txt")).alias("p"),
                   F.concat_ws(" ", "chrom", F.col("n").cast("string")).alias("value")).write.partitionBy("p").text(path))
    return readers.read_counts(spark, path, r"sites\.([\d.]+)\.(\d+)\.txt", ["alpha", "cutoff"]).drop("p")


fragment("v_summary", segments.SUMMARY_SQL)


@query("hmm_log_files", "SELECT * EXCLUDE (param_id) FROM v_summary")
def hmm_log_files(spark, d):
    path = shared_path(spark, "hmm-log")
    sinks.write_hmm_log(segments.hmm_summary(spark, d), path)
    return readers.read_hmm_logs(spark, path)


@query("sample_sheet_files", """
  SELECT accession, round(CAST(gc AS DOUBLE), 6) AS gc, gc IS NULL AS missing FROM v_filled""")
def sample_sheet_files(spark, d):
    path = shared_path(spark, "samples")
    sinks.write_samples(trees._filled(spark, d), path)
    sheet = readers.read_samples(spark, path)
    return sheet.select("accession", r6(F.col("gc").try_cast("double"), "gc"), (F.col("gc") == "NA").alias("missing"))


@query("likelihood_files", """
  SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size - 25 AS DOUBLE) AS logbf1, p_retailprice - 950 AS logbf2 FROM part""")
def likelihood_files(spark, d):
    path = shared_path(spark, "likelihood")
    A.elem_lik(spark, d).write.options(sep="\t", header=True).csv(path)
    return readers.read_elem_lik(spark, path)


@query("tree_table_files", """
  SELECT CAST(t.tree_id AS VARCHAR) AS tree_id, t.node, string_agg(upper(u.tip), ';' ORDER BY upper(u.tip)) AS clade, t.node_type,
         t.branch_length, t.label
  FROM v_typed t LEFT JOIN v_under u ON u.tree_id = t.tree_id AND u.anc = t.node
  GROUP BY t.tree_id, t.node, t.node_type, t.branch_length, t.label""")
def tree_table_files(spark, d):
    path = shared_path(spark, "trees")
    sinks.write_tree_info(trees.clade_table(spark, d), path)
    table = spark.read.option("header", True).csv(path)
    return table.withColumn("branch_length", F.col("branch_length").cast("double"))


@query("line_files", "SELECT s_name AS species FROM supplier")
def line_files(spark, d):
    return readers.read_lines(spark, _written(A.table(spark, d, "supplier").select("s_name"), "lines"))


@query("union_of_trees", """
  SELECT tree_id, node, label, node_type, CASE WHEN tree_id % 2 = 0 THEN 'even' ELSE 'odd' END AS set_name FROM v_typed""")
def union_of_trees(spark, d):
    """Two tables of trees, each described on its own and put below the other."""
    nodes = written(A.customer_trees(spark, d), "trees")
    parts = [trees.tree.tree_info(nodes.where(F.col("tree_id") % 2 == k)).withColumn("set_name", F.lit(name))
             for k, name in ((0, "even"), (1, "odd"))]
    return sites.union_all(parts).select("tree_id", "node", "label", "node_type", "set_name")
