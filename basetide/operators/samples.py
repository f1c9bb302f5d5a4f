"""Sample sheets: GC look-up and average."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_gc(samples: DataFrame, lookup: DataFrame) -> DataFrame:
    """GC percent from the sheet when numeric, else from the look-up by accession, else NULL.

    ``lookup`` has (accession, gc), gc NULL for a report without a value. Adds ``gc_source``:
    sheet, lookup, no_value (report without a number) or failed (accession not found).
    """
    has_gc = "gc" in samples.columns
    own = F.col("gc").try_cast("double") if has_gc else F.lit(None).cast("double")
    found = lookup.select("accession", F.col("gc").try_cast("double").alias("_found"), F.lit(True).alias("_hit"))
    out = samples.withColumn("_own", own).join(found, "accession", "left")
    source = (F.when(F.col("_own").isNotNull(), "sheet").when(F.col("_found").isNotNull(), "lookup")
              .when(F.col("_hit"), "no_value").otherwise("failed"))
    rest = [c for c in samples.columns if c != "gc"]
    return out.select(*rest, F.coalesce("_own", "_found").alias("gc"), source.alias("gc_source"))


def gc_report(filled: DataFrame) -> DataFrame:
    """Rows per source of the GC value."""
    return filled.groupBy("gc_source").agg(F.count(F.lit(1)).alias("n"))


def avg_gc(filled: DataFrame) -> DataFrame:
    """Mean GC over the rows that have a value, as a fraction."""
    return filled.agg((F.avg("gc") / 100).alias("avg_gc"))
