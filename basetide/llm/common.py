"""Shared helpers: tables, shared storage, keys of documents, prefix sums over partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basetide.plans.lineage import cut
from basetide.session import ensure_checkpoint_dir

#: Words are runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the cluster's shared checkpoint folder and read it back.

    Like ``cut`` it ends the lineage with files that survive lost executors; unlike a checkpoint the
    files are columnar and compressed, so later readers load only the columns they name.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")  # the shuffles of this write are of no use once the table stands
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) with null texts as empty ones; other columns never travel."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n: the fixed split into training and held-out rows."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def partition_bases(sizes: DataFrame, part: str, n: str, out: str) -> DataFrame:
    """Exclusive prefix sum of per-partition totals. One row per partition goes through the window,
    so its size is the number of partitions or files and not of rows."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy(part).agg(F.sum(n).alias("_n"))
    return totals.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(out))


__all__ = ["SPACE_PATTERN", "WORD_PATTERN", "crc_mod", "cut", "free_names", "partition_bases", "stored", "table", "texts"]
