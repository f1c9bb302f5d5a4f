"""Readers for the text formats. Each is one lazy scan; records span lines through ``lineSep``.

A record is one row, so it must fit in memory: an alignment block, a FASTA entry of ``read_fasta``. Whole chromosomes are read
in pieces by ``read_genome``, fixedStep blocks line by line.
All columns are declared, nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basetide.sources.carried import read_genome, read_wig_lines  # noqa: F401

BED3 = "chrom string, start long, end long"


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _tsv(spark: SparkSession, path, schema: str, sep: str = "\t", **options) -> DataFrame:
    return spark.read.schema(schema).options(sep=sep, quote="", **options).csv(_paths(path))


def read_bed(spark: SparkSession, path: str | Sequence[str], extra: str = "") -> DataFrame:
    """BED3, or BED3 plus the columns declared in ``extra`` ("name string, n int")."""
    return _tsv(spark, path, f"{BED3}, {extra}" if extra else BED3)


def read_bedgraph(spark: SparkSession, path: str | Sequence[str], value: str = "score") -> DataFrame:
    return _tsv(spark, path, f"{BED3}, {value} double", comment="#")


def read_scored_sites(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_bed(spark, path, "score double, status tinyint, p_value double")


def read_adjusted_sites(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_bed(spark, path, "status tinyint, p_adj double, sig tinyint")


def read_conserved(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_bed(spark, path, "sig_code string")


def read_depth(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_bed(spark, path, "depth int")


def read_clusters(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Cluster rows with the two size parameters taken from a ``-{size}-{samples}`` part of the
    file name when it has one."""
    df = read_bed(spark, path, "cluster_id string, num_conserved long")
    name = F.col("_metadata.file_name")
    parts = [F.regexp_extract(name, r"-(\d+)-(\d+)[^-/]*$", i).try_cast("int").alias(n)
             for i, n in ((1, "min_cluster_size"), (2, "min_samples"))]
    return df.select("*", *parts)


def read_batches(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Locus batches, the batch number being the leading digits of the file name."""
    df = _tsv(spark, path, "idx long, start long, end long, name string")
    return df.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("int").alias("batch_id"), "*")


def read_fai(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Genome index with ``ord``, the natural order of the names (numbers first)."""
    df = _tsv(spark, path, "chrom string, length long, byte_offset long, line_bases int, line_width int")
    bare = F.regexp_replace("chrom", "^chr", "")
    rank = F.coalesce(bare.try_cast("int"), F.when(bare == "X", 1000).when(bare == "Y", 1001).when(
        bare.isin("M", "MT"), 1002).otherwise(2000))
    return df.withColumn("ord", rank).withColumn("chrom", F.concat(F.lit(prefix), "chrom"))


def read_wig_fixedstep(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """fixedStep WIG -> one 1-bp row per score; the 1-based start becomes 0-based. A block may span any number of tasks.

    Blank, track, browser and comment lines are passed over; other lines outside a fixedStep block and values that are no
    numbers are errors."""
    lines = read_wig_lines(spark, path)

    def field(name: str) -> Column:
        return F.regexp_extract("header", rf"\b{name}=(\S+)", 1)

    known = F.col("header").rlike("^fixedStep") & F.col("header").rlike(r"\bchrom=\S+") & F.col("header").rlike(r"\bstart=\d+(\s|$)")
    bad_block = F.raise_error(F.concat(F.lit("not a fixedStep block: "), F.substring(F.coalesce("header", "text"), 1, 80))).cast("boolean")
    first = field("start").cast("long") - 1
    start = first + F.col("k") * F.coalesce(field("step").try_cast("long"), F.lit(1))
    bad_value = F.raise_error(F.concat(F.lit("not a score: "), "text")).cast("double")
    score = F.coalesce(F.col("text").try_cast("double"), bad_value)
    return lines.where(F.coalesce(known, F.lit(False)) | bad_block).select(
        field("chrom").alias("chrom"), start.alias("start"), (start + 1).alias("end"), score.alias("score"))


def read_maf(spark: SparkSession, path: str | Sequence[str], partitions: Sequence[str] = ()) -> DataFrame:
    """Alignment blocks, one row each. The source name is split at its first dot into species and
    scaffold; the first row is the reference and gives chrom, start and size. Names of ``partitions`` are directories
    (``name=value``) of a partitioned alignment and become columns ``in_{name}``."""
    schema = ", ".join(["value string", *(f"`{p}` string" for p in partitions)])
    return _maf_blocks(spark.read.schema(schema).option("lineSep", "\na").text(_paths(path)), partitions)


def read_maf_archive(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``read_maf`` of the files in a table of ``sinks.write_maf_archive``, with ``in_chrom`` and ``in_win``."""
    raw = spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)
    return _maf_blocks(raw.select(F.explode(F.split("text", "\na")).alias("value"), "chrom", "win"), ("chrom", "win"))


def _maf_blocks(raw: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Blocks of raw records (value and the columns ``partitions``), which end in front of the next line that starts with an a."""
    where = [F.col(p).alias(f"in_{p}") for p in partitions]
    lines = F.filter(F.split(F.regexp_replace("value", "\r", ""), "\n"), lambda x: x.rlike(r"^s\s"))
    fields = F.transform(lines, lambda line: F.split(line, r"\s+"))  # each line is split once

    def row(f: Column) -> Column:
        # everything in front of the first dot, and what follows it
        return F.struct(F.substring_index(f[1], ".", 1).alias("species"), F.regexp_replace(f[1], r"^[^.]*\.?", "").alias("scaffold"),
                        f[2].cast("long").alias("start"), f[3].cast("long").alias("size"), f[4].alias("strand"),
                        f[5].cast("long").alias("src_size"), f[6].alias("text"))

    blocks = raw.select(F.transform(fields, row).alias("rows"), *where).where(F.size("rows") > 0)
    ref = F.get("rows", F.lit(0))
    return blocks.select(F.xxhash64(ref["scaffold"], ref["start"]).alias("block_id"), ref["scaffold"].alias("chrom"),
                         ref["start"].alias("start"), ref["size"].alias("size"), "rows", *(f"in_{p}" for p in partitions))


def read_fasta(spark: SparkSession, path: str | Sequence[str], files: str = "*.{fa,fasta,fna}") -> DataFrame:
    """FASTA files -> (file, title, seq); wrapped lines are joined, blank lines skipped."""
    raw = spark.read.options(lineSep="\n>", pathGlobFilter=files).text(_paths(path))
    entry = F.regexp_replace("value", r"^\s*>|\r", "")
    seq = F.regexp_replace(F.expr("substring(value, instr(value, '\n') + 1)"), r"\s", "")
    return (raw.select(F.col("_metadata.file_name").alias("file"), entry.alias("value")).where(F.trim("value") != "")
            .select("file", F.trim(F.substring_index("value", "\n", 1)).alias("title"),
                    F.when(F.col("value").contains("\n"), seq).otherwise("").alias("seq")))


def fasta_alignments(fasta: DataFrame, delim: str = ".", region_in_title: bool = False) -> DataFrame:
    """FASTA rows of region files -> alignment records with region_id, coordinates and species.

    The region is the file's name, or with ``region_in_title`` what follows the last space of the title."""
    from basetide.functions.sequences import parse_region_name

    title = F.regexp_replace("title", r" \S*$", "") if region_in_title else F.col("title")
    base = F.substring_index("title", " ", -1) if region_in_title else F.regexp_replace("file", r"(-dedup)?\.(fa|fasta|fna)$", "")
    region = parse_region_name(base)
    return fasta.select(base.alias("region_id"), region["chrom"].alias("chrom"), region["start"].alias("start"),
                        region["end"].alias("end"), F.substring_index(title, delim, 1).alias("species"), title.alias("title"), "seq")


def read_ss(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Site-pattern file -> header (key, value) and patterns (idx, pattern, n)."""
    lines = spark.read.text(path)
    header = lines.where(F.col("value").rlike(r"^[A-Z_]+ = ")).select(
        F.substring_index("value", " = ", 1).alias("key"), F.expr("substring(value, instr(value, ' = ') + 3)").alias("value"))
    f = F.split("value", "\t")
    patterns = lines.where(F.col("value").rlike(r"^\d+\t")).select(
        f[0].cast("long").alias("idx"), f[1].alias("pattern"), f[2].cast("long").alias("n"))
    return header, patterns


def read_gff(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """GFF3 with its pragma lines: feature rows have the nine columns, pragma rows only ``pragma``."""
    lines = spark.read.text(_paths(path)).where(F.trim("value") != "")
    is_pragma = F.col("value").rlike("^#[#!]")
    f = F.split("value", "\t")
    cols = [("seqid", "string"), ("source", "string"), ("type", "string"), ("start", "long"), ("end", "long"),
            ("score", "string"), ("strand", "string"), ("phase", "string"), ("attributes", "string")]
    return lines.where(is_pragma | ~F.col("value").startswith("#")).select(
        F.when(is_pragma, F.col("value")).alias("pragma"),
        *[F.when(~is_pragma, F.try_element_at(f, F.lit(i + 1)).try_cast(t)).alias(n) for i, (n, t) in enumerate(cols)])


def gff_for_chrom(gff: DataFrame, chrom: str, prefix: str = "") -> DataFrame:
    """Pragmas and the features of one chromosome, its name prefixed."""
    kept = gff.where(F.col("pragma").isNotNull() | (F.col("seqid") == chrom))
    return kept.withColumn("seqid", F.concat(F.lit(prefix), "seqid"))


def gff_chromosomes(gff: DataFrame) -> DataFrame:
    return gff.where(F.col("type").contains("chromosome"))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet CSV; header names are lower-cased and must include ``accession``."""
    df = spark.read.options(header=True, comment="#").csv(path)
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    if "accession" not in df.columns:
        raise ValueError("the sample sheet has no accession column")
    return df


def read_counts(spark: SparkSession, path: str | Sequence[str], name_regex: str, names: Sequence[str],
                key: str = "chrom") -> DataFrame:
    """Space-separated ``key count`` files read as one table; the groups of ``name_regex`` (matched
    on the path, so a folder of part files counts as a file) become the string columns ``names``."""
    df = _tsv(spark, path, f"{key} string, n long", sep=" ")
    found = [F.regexp_extract(F.col("_metadata.file_path"), name_regex, i + 1).alias(n) for i, n in enumerate(names)]
    return df.select("*", *found)


def read_elem_lik(spark: SparkSession, path: str) -> DataFrame:
    """Likelihood results: tab-separated with a header and ``#`` comments; all columns are text
    except logbf1 and logbf2."""
    df = spark.read.options(sep="\t", header=True, comment="#").csv(path)
    return df.withColumn("logbf1", F.col("logbf1").cast("double")).withColumn("logbf2", F.col("logbf2").cast("double"))


# Fixed column order of segmentation logs.
HMM_LOG = ("chrom string, length long, conserved_sites long, total_elements long, too_short long, too_long long, "
           "final_elements long, mean_length double, mean_gap double, sites_in_elements long, mean_density double, "
           "t0_0 double, t1_1 double, e0_0 double, e1_1 double, s0 double, min_len int")


def read_hmm_logs(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Segmentation logs (their header lines start with #), many files as one table."""
    return _tsv(spark, path, HMM_LOG, comment="#")


def read_lines(spark: SparkSession, path: str, name: str = "species") -> DataFrame:
    """One value per line, blank lines skipped."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.trim("value").alias(name))
