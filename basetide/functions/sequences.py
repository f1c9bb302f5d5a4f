"""Column expressions on sequences, names, trees and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GAP_CHARS = "[-nN]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def count_char(col: Column | str, char: str) -> Column:
    c = _c(col)
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def gap_count(col: Column | str) -> Column:
    return count_char(col, "-")


def ungapped_length(col: Column | str) -> Column:
    return F.length(F.replace(_c(col), F.lit("-"), F.lit("")))


def informative_length(col: Column | str) -> Column:
    """Characters that are neither gap nor unknown base."""
    return F.length(F.regexp_replace(_c(col), GAP_CHARS, ""))


def slice_seq(col: Column | str, i: Column | int, j: Column | int) -> Column:
    """Characters i .. j-1, counted from 0."""
    i, j = (F.lit(v) if isinstance(v, int) else v for v in (i, j))
    return F.substring(_c(col), i.cast("int") + 1, (j - i).cast("int"))


def pad_gaps(n: Column) -> Column:
    return F.repeat(F.lit("-"), F.greatest(n, F.lit(0)).cast("int"))


def columns_of(texts: Column | str) -> Column:
    """Rows to columns: an array of the column strings of equally long texts. Each text is taken apart once. For small
    alignments; large ones go through ``site_patterns`` or ``maf_depth``."""
    t = _c(texts)
    letters = F.transform(t, lambda s: F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0)))
    n = F.length(t[0])

    def transposed(rows: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_join(F.transform(rows, lambda x: F.get(x, i)), ""))

    # an array of one keeps the letters, which every column would otherwise take apart again
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.flatten(F.transform(F.array(letters), transposed)))


def parse_region_name(col: Column | str) -> Column:
    """``{ref}-{chrom}-{start}-{end}`` with an optional suffix -> struct(ref, chrom, start, end)."""
    parts = F.split(_c(col), "-")
    end = F.regexp_extract(parts[3], r"^(\d+)", 1)
    return F.struct(parts[0].alias("ref"), parts[1].alias("chrom"), parts[2].cast("long").alias("start"),
                    end.cast("long").alias("end"))


def region_name(ref: Column | str, chrom: Column | str, start: Column | str, end: Column | str) -> Column:
    ref = F.lit(ref) if isinstance(ref, str) else ref
    return F.concat_ws("-", ref, _c(chrom), _c(start).cast("string"), _c(end).cast("string"))


def strip_topology(col: Column | str) -> Column:
    """Newick text without branch lengths, internal node labels and the closing semicolon."""
    no_lengths = F.regexp_replace(_c(col), r":[^,()\s;]+", "")
    return F.regexp_replace(F.regexp_replace(no_lengths, r"\)[^,()\s;]+", ")"), r"[\s;]", "")


def tip_labels(col: Column | str) -> Column:
    """Tip names of a Newick text, in text order."""
    flat = F.regexp_replace(strip_topology(col), r"[()]", "")
    return F.filter(F.split(flat, ","), lambda t: t != "")


def gc_from_report(col: Column | str) -> Column:
    """GC percent of a JSON assembly report; NULL when the key is missing or not a number."""
    return F.get_json_object(_c(col), "$.reports[0].assembly_stats.gc_percent").try_cast("double")
