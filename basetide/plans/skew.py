"""Salting of hot join keys with an exact, deterministic assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.plans.lineage import cut

HOT_ROWS = 1_000_000


def salted(df: DataFrame, n: Column, out: str) -> DataFrame:
    """``df`` with a salt below ``n`` that a recomputed task gives each row again. Equal rows are counted and numbered first, so that
    they spread as well as different ones."""
    names = [f"`{c}`" for c in df.columns]
    copies = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n_equal"))
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n_equal"))))
    return copies.withColumn(out, F.pmod(F.xxhash64(*names, "_copy"), n).cast("int")).drop("_n_equal", "_copy")


def lookup_join(big: DataFrame, lookup: DataFrame, counts: DataFrame, keys: Sequence[str], n_col: str,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of ``big`` to a lookup that has one row per key; ``counts`` (and the lookup itself)
    say in ``n_col`` how many rows of ``big`` carry the key.

    Keys with more than ``hot_rows`` rows are spread over several salts and their lookup row is
    repeated once per salt. The table of hot keys can hold at most ``rows / hot_rows`` rows, which
    is the bound that makes broadcasting it safe. The salt is a hash of the row, so a recomputed
    task sends every row to the same place; rows of ``big`` should differ.
    """
    hot = (counts.where(F.col(n_col) > hot_rows)
           .select(*keys, F.ceil(F.col(n_col) / hot_rows).cast("int").alias("_salts")))
    spread = big.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.when(F.col("_salts").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64(*big.columns), F.col("_salts"))).cast("int"))
    copies = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col(n_col) / hot_rows).cast("int"), F.lit(1)) - 1)))
    joined = spread.join(copies.drop(n_col), [*keys, "_salt"], "left")
    return joined.drop("_salt", "_salts")


def grid_salt(left: DataFrame, right: DataFrame, keys: Sequence[str],
              hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Give both sides ``_ls`` / ``_rs`` columns so that a join on ``keys + [_ls, _rs]`` meets every
    pair once and no cell of a hot key holds more than about ``hot_rows`` rows of either side.

    A key with L left and R right rows becomes a grid of ceil(L/hot_rows) x ceil(R/hot_rows) cells.
    The hot-key table has at most ``(rows left + rows right) / hot_rows`` rows, hence the broadcast.
    """
    def hot(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        return counts.where(F.col("_n") > hot_rows).select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias(name))

    cells = cut(hot(left, "_nl").join(hot(right, "_nr"), list(keys), "full"))
    if cells.isEmpty():
        return tuple(df.withColumn("_ls", F.lit(0)).withColumn("_rs", F.lit(0)) for df in (left, right))

    def place(df: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        met = df.join(F.broadcast(cells), list(keys), "left")
        crowded = F.col(own_n).isNotNull()
        spread = met.where(~crowded).withColumn(own, F.lit(0)).unionByName(salted(met.where(crowded), F.col(own_n), own))
        return (spread.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other_n), F.lit(1)) - 1)))
                .drop(own_n, other_n))

    return place(left, "_ls", "_nl", "_rs", "_nr"), place(right, "_rs", "_nr", "_ls", "_nl")
