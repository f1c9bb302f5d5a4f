"""Session helper used by the tests and the benchmark. On a cluster, bring your own session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "basetide",
                  memory: str = "12g") -> SparkSession:
    """A local session with the settings the plans expect (AQE on, UTC, Arrow)."""
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.local.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``; fall back to a temporary one only
    when the session names none (tests, laptop runs)."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-ckpt-", dir="/tmp"))
