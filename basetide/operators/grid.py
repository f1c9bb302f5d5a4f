"""Parameter grids, grid features and threshold-grid counts."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def param_grid(spark: SparkSession, **lists: Iterable) -> DataFrame:
    """Every combination of the named value lists, one column per name. The lists are user settings
    (thousands of combinations at most), so the grid is a literal table."""
    names = list(lists)
    return spark.createDataFrame([tuple(row) for row in product(*[list(v) for v in lists.values()])], names)


def grid_over(df: DataFrame, grid: list[dict]) -> DataFrame:
    """Repeat every row of ``df`` for every parameter set, as columns, with one explode."""
    sets = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in g.items()]) for g in grid])
    return df.withColumn("_set", F.explode(sets)).select(*df.columns, *[F.col(f"_set.{k}").alias(k) for k in grid[0]])


def hmm_grid_features(df: DataFrame) -> DataFrame:
    """Ratio, difference, product and "a-b" key of the transition and emission pairs, and the share
    of all conserved sites that lie in elements."""
    out = df
    for tag, a, b in (("t", "t0_0", "t1_1"), ("e", "e0_0", "e1_1")):
        x, y = F.col(a), F.col(b)
        out = (out.withColumn(f"{tag}_ratio", x / y).withColumn(f"{tag}_diff", x - y)
               .withColumn(f"{tag}_prod", x * y)
               .withColumn(f"{tag}_key", F.concat_ws("-", x.cast("string"), y.cast("string"))))
    share = F.when(F.col("conserved_sites") > 0, F.col("sites_in_elements") / F.col("conserved_sites"))
    return out.withColumn("share_in_elements", share)


def grid_slice(df: DataFrame, **fixed: float) -> DataFrame:
    """Rows of a grid report with the given parameters held fixed."""
    for name, value in fixed.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def grid_below(df: DataFrame, **limits: float) -> DataFrame:
    """Rows of a grid report whose named columns all lie below their limits."""
    for name, limit in limits.items():
        df = df.where(F.col(name) < F.lit(limit))
    return df


def classify_acceleration(df: DataFrame, bf1: float = 5, bf2: float = 5, max_bf1: float = 200,
                          min_bf2: float = -500) -> DataFrame:
    """Bayes-factor flags, the class they give, and whether the row is inside the display range."""
    a1, a2 = F.col("logbf1") > bf1, F.col("logbf2") > bf2
    return (df.withColumn("above_bf1", a1).withColumn("above_bf2", a2)
            .withColumn("accelerated", F.when(a1 & a2, "Accelerated").otherwise("Not accelerated"))
            .withColumn("displayed", (F.col("logbf1") < max_bf1) & (F.col("logbf2") > min_bf2)))


def grid_exceedance(df: DataFrame, lo: int = -20, hi: int = 20) -> DataFrame:
    """For every integer pair (bf1, bf2) in lo..hi: rows with logbf1 > bf1 and logbf2 > bf2.

    Each row falls into one cell (the largest thresholds it exceeds), so the table shrinks to at
    most (hi - lo + 1)^2 counts in one map-side combined aggregate; the counts are then summed over
    the cells above and to the right, first along one axis and then along the other.
    """
    def largest_below(col: str):
        return F.least(F.ceil(F.col(col)) - 1, F.lit(hi)).cast("int")

    cells = (df.select(largest_below("logbf1").alias("a"), largest_below("logbf2").alias("b"))
             .where((F.col("a") >= lo) & (F.col("b") >= lo))
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    rows = (cells.withColumn("bf1", F.explode(F.sequence(F.lit(lo), "a")))
            .groupBy("bf1", "b").agg(F.sum("n").alias("n")))
    counted = (rows.withColumn("bf2", F.explode(F.sequence(F.lit(lo), "b")))
               .groupBy("bf1", "bf2").agg(F.sum("n").alias("n")))
    axis = df.sparkSession.range(lo, hi + 1)
    grid = axis.select(F.col("id").cast("int").alias("bf1"), F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("bf2"))
    return grid.join(counted, ["bf1", "bf2"], "left").select("bf1", "bf2", F.coalesce("n", F.lit(0)).alias("n_above"))
