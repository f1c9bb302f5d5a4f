"""Cutting plans between chained scans."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from basetide.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once with a reliable checkpoint and go on from the files.

    A tiled scan reads its input twice, so k scans on top of each other would plan 2^k copies of
    the input. A checkpoint between them keeps the plan linear, and lost executors re-read files
    instead of recomputing the chain. The folder is the cluster's ``spark.checkpoint.dir``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared checkpoint folder, for files that are read back."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffles of the writes inside are of no use once their files stand, and go with the end of each."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut``, as compressed columns: for long tables, of which a reader takes the columns it needs."""
    path = shared_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
