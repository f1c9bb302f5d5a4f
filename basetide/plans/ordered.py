"""Ordered scans (running sum / max / min / previous row) without one-task groups.

``Window.partitionBy("chrom").orderBy("start")`` puts a whole chromosome into one task, and a
genome-wide ``Window.orderBy("p")`` puts everything there. The scans here work in two levels:

1. the ordered axis is cut into *tiles*, and a normal window runs inside each tile;
2. one summary row per tile goes through a small window over tiles, which yields what enters each
   tile from the tiles before (or after) it; that carry is joined back on the tile key.

Callers first collapse the input to distinct (key, order value) rows with a map-side combined
``groupBy``. After that a position tile of width W holds at most W rows whatever the skew, and the
summary has at most ``axis length / W`` rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TILE_WIDTH = 1 << 17


@dataclass(frozen=True)
class Scan:
    """One running aggregate. ``fn`` is sum, max, min, last (latest non-null value) or total (whole
    key); ``reverse`` runs from the largest order value down; ``inclusive`` counts the row itself."""

    out: str
    fn: str
    col: str
    reverse: bool = False
    inclusive: bool = True


def position_tile(col: str, width: int = TILE_WIDTH) -> Column:
    return F.floor(F.col(col) / F.lit(width)).cast("long")


def placed(df: DataFrame, *cols: str) -> DataFrame:
    """Rows that have a place on the axis. Stating it up front also gives both branches of a scan the
    same filters, so that they share one shuffle."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def value_tiles(df: DataFrame, col: str, out: str = "_tile", tiles: int | None = None) -> DataFrame:
    """Add a balanced, order-preserving tile number for a numeric column.

    The split points come from one column-pruned, map-side combined quantile-digest aggregate and
    are literals in the returned plan, so a recomputed task always assigns the same tile. They only
    steer balance: any split points give the same scan results.
    """
    tiles = tiles or _default_tiles(df.sparkSession)
    probs = [i / tiles for i in range(1, tiles)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, max(10000, 10 * tiles)).alias("s")).first()
    points = sorted({float(x) for x in (row["s"] or []) if x == x and abs(x) != float("inf")})
    as_double = f"{out}_v"
    bucketed = Bucketizer(splits=[float("-inf"), *points, float("inf")] if points else
                          [float("-inf"), 0.0, float("inf")],
                          inputCol=as_double, outputCol=out, handleInvalid="keep")
    return (bucketed.transform(df.withColumn(as_double, F.col(col).cast("double")))
            .withColumn(out, F.col(out).cast("long")).drop(as_double))


def _default_tiles(spark: SparkSession) -> int:
    return max(16, min(8192, 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str, tile: Sequence[str] | str,
                 scans: Sequence[Scan]) -> DataFrame:
    """Add the columns asked for in ``scans``; tiles must ascend with the order columns."""
    order = [order] if isinstance(order, str) else list(order)
    tile = [tile] if isinstance(tile, str) else list(tile)
    cell = [*keys, *tile]

    aggs, carries, locals_ = [], [], []
    for i, s in enumerate(scans):
        part, carry, here = f"_part{i}", f"_carry{i}", f"_here{i}"
        aggs.append(_summary(s, order).alias(part))
        tiles_w = Window.partitionBy(*keys)
        if s.fn == "total":
            carries.append(F.sum(part).over(tiles_w).alias(carry))
            continue
        tiles_w = _ordered(tiles_w, tile, s.reverse).rowsBetween(Window.unboundedPreceding, -1)
        carries.append(_fold(s, part).over(tiles_w).alias(carry))
        row_w = _ordered(Window.partitionBy(*cell), order, s.reverse)
        row_w = row_w.rowsBetween(Window.unboundedPreceding, 0 if s.inclusive else -1)
        locals_.append(_fold(s, s.col).over(row_w).alias(here))

    summary = df.groupBy(*cell).agg(*aggs)
    carry = summary.select(*cell, *carries)
    scanned = df.select("*", *locals_) if locals_ else df
    joined = scanned.join(carry, cell, "left")
    names = {s.out: _combine(s, f"_here{i}", f"_carry{i}") for i, s in enumerate(scans)}
    kept = [c for c in df.columns if c not in names]
    return joined.select(*kept, *[c.alias(n) for n, c in names.items()])


def _ordered(w, cols: Sequence[str], reverse: bool):
    return w.orderBy(*[F.col(c).desc() if reverse else F.col(c).asc() for c in cols])


def _summary(s: Scan, order: Sequence[str]) -> Column:
    if s.fn == "last":
        by = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
        by = F.when(F.col(s.col).isNotNull(), by)
        return F.min_by(s.col, by) if s.reverse else F.max_by(s.col, by)
    return {"sum": F.sum, "total": F.sum, "max": F.max, "min": F.min}[s.fn](s.col)


def _fold(s: Scan, col: str) -> Column:
    if s.fn == "last":
        return F.last(col, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min}[s.fn](col)


def _combine(s: Scan, here: str, carry: str) -> Column:
    if s.fn == "total":
        return F.col(carry)
    if s.fn == "sum":
        return F.coalesce(F.col(here), F.lit(0)) + F.coalesce(F.col(carry), F.lit(0))
    if s.fn == "last":
        return F.coalesce(F.col(here), F.col(carry))
    return (F.greatest if s.fn == "max" else F.least)(F.col(here), F.col(carry))


def value_histogram(df: DataFrame, keys: Sequence[str], col: str, tiles: int | None = None) -> DataFrame:
    """(keys, value) -> n, cum (rows <= value) and total, all per key. NULL values are left out."""
    tiled = value_tiles(placed(df, *keys, col), col, tiles=tiles)
    counts = tiled.groupBy(*keys, "_tile", col).agg(F.count(F.lit(1)).alias("n"))
    scanned = ordered_scan(counts, keys, col, "_tile", [Scan("cum", "sum", "n"), Scan("total", "total", "n")])
    return scanned.drop("_tile")


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: dict[str, float],
                    tiles: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles, one output column per entry of ``probs``.

    ``percentile`` keeps every distinct value of a group in one buffer; here the group is a
    distributed histogram and only the two rows around each rank are kept.
    """
    h = value_histogram(df, keys, col, tiles)
    value, first, last = F.col(col).cast("double"), F.col("cum") - F.col("n"), F.col("cum") - 1
    picks, outs = [], []
    for name, p in probs.items():
        at = (F.col("total") - 1) * F.lit(float(p))
        lo, hi = F.floor(at), F.ceil(at)
        picks += [F.max(F.when((first <= lo) & (lo <= last), value)).alias(f"{name}_lo"),
                  F.max(F.when((first <= hi) & (hi <= last), value)).alias(f"{name}_hi")]
        at_all = (F.col("_total") - 1) * F.lit(float(p))
        outs.append((F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * (at_all - F.floor(at_all)))
                    .alias(name))
    agg = h.groupBy(*keys).agg(F.max("total").alias("_total"), *picks)
    return agg.select(*keys, *outs)
