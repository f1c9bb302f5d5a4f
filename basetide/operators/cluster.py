"""One-dimensional density clustering of site positions and cluster summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basetide.plans.lineage import cut
from basetide.plans.ordered import TILE_WIDTH, Scan, exact_quantiles, ordered_scan, placed, position_tile


def core_distances(sites: DataFrame, min_samples: int, rank_tile: int = 1 << 16,
                   tile_width: int = TILE_WIDTH) -> DataFrame:
    """Distance of every distinct position to its (min_samples - 1)-th nearest neighbour, itself
    counted first; NULL on a chromosome with fewer sites than that.

    Positions are re-tiled by rank: each rank tile is full, so the m rows borrowed from either
    neighbour tile hold every neighbour that can matter. Copies of one position beyond min_samples
    cannot change a distance and are not laid out.
    """
    m = min_samples - 1
    if rank_tile < max(1, m):
        raise ValueError("rank_tile must be at least min_samples - 1")
    distinct = placed(sites, "chrom", "start").groupBy("chrom", "start").agg(F.count(F.lit(1)).alias("copies"))
    laid = distinct.withColumn("_tile", position_tile("start", tile_width)).withColumn(
        "_k", F.least(F.col("copies"), F.lit(min_samples)))
    ranked = ordered_scan(laid, ["chrom"], "start", "_tile", [Scan("_end", "sum", "_k")])
    points = ranked.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_k"))).select(
        "chrom", "start", "copies", "_copy", (F.col("_end") - F.col("_k") + F.col("_copy") - 1).alias("_rank"))

    home, inside = F.floor(F.col("_rank") / rank_tile), F.col("_rank") % rank_tile
    spots = F.array_compact(F.array(home, F.when(inside < m, home - 1), F.when(inside >= rank_tile - m, home + 1)))
    haloed = points.withColumn("_home", home).withColumn("_spot", F.explode(spots))
    around = Window.partitionBy("chrom", "_spot").orderBy("_rank").rowsBetween(-m, m)
    near = F.collect_list(F.struct("_rank", "start")).over(around)
    own = haloed.withColumn("_near", near).where((F.col("_spot") == F.col("_home")) & (F.col("_copy") == 1))
    # a span of m + 1 consecutive ranks containing this one costs the distance to its further end
    spans = F.transform(
        F.filter("_near", lambda r: (r["_rank"] <= F.col("_rank")) & (F.try_element_at(
            F.col("_near"), (r["_rank"] - F.col("_near")[0]["_rank"] + m + 1).cast("int")).isNotNull())),
        lambda r: F.greatest(F.col("start") - r["start"], F.element_at(
            F.col("_near"), (r["_rank"] - F.col("_near")[0]["_rank"] + m + 1).cast("int"))["start"] - F.col("start")))
    return own.select("chrom", "start", "copies", F.array_min(spans).alias("core_dist"))


def density_islands(sites: DataFrame, min_samples: int, eps: float | None = None, eps_percentile: float = 0.5,
                    tile_width: int = TILE_WIDTH) -> DataFrame:
    """Every distinct position with the island it belongs to (``_cluster``, the first core position
    of the island, or NULL): the part of clustering that does not depend on the cluster size."""
    cores = cut(core_distances(sites, min_samples, tile_width=tile_width))
    if eps is None:
        eps = exact_quantiles(cores, [], "core_dist", {"q": eps_percentile}).first()["q"]
    x = F.col("start")
    rows = cores.withColumn("_tile", position_tile("start", tile_width)).withColumn(
        "_core", F.when(F.col("core_dist") <= eps, x))
    near = ordered_scan(rows, ["chrom"], "start", "_tile", [
        Scan("_left", "max", "_core"), Scan("_before", "max", "_core", inclusive=False),
        Scan("_right", "min", "_core", reverse=True)])
    opens = F.col("_core").isNotNull() & (F.col("_before").isNull() | (x - F.col("_before") > eps))
    islands = ordered_scan(near.withColumn("_open", F.when(opens, x)), ["chrom"], "start", "_tile",
                           [Scan("_island", "max", "_open")])
    to_left, to_right = x - F.col("_left"), F.col("_right") - x
    right_island = F.when(F.col("_right") - F.col("_left") <= eps, F.col("_island")).otherwise(F.col("_right"))
    use_left = (to_left <= eps) & (F.col("_right").isNull() | (to_left <= to_right))
    cluster = F.when(use_left, F.col("_island")).when(to_right <= eps, right_island)
    return cut(islands.withColumn("_cluster", cluster).select("chrom", "start", "copies", "core_dist", "_cluster"))


def label_islands(placed: DataFrame, min_cluster_size: int, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Number the islands that hold at least ``min_cluster_size`` sites; all else is noise, -1."""
    sizes = (placed.where(F.col("_cluster").isNotNull()).groupBy("chrom", "_cluster")
             .agg(F.sum("copies").alias("_size")).where(F.col("_size") >= min_cluster_size))
    sizes = sizes.withColumn("_one", F.lit(1).cast("long")).withColumn("_ctile", position_tile("_cluster", tile_width))
    labels = ordered_scan(sizes, ["chrom"], "_cluster", "_ctile", [Scan("label", "sum", "_one", inclusive=False)])
    return (placed.join(labels.select("chrom", "_cluster", "label"), ["chrom", "_cluster"], "left")
            .select("chrom", "start", "copies", "core_dist", F.coalesce("label", F.lit(-1)).cast("long").alias("label")))


def cluster_positions(sites: DataFrame, min_cluster_size: int, min_samples: int, eps: float | None = None,
                      eps_percentile: float = 0.5, tile_width: int = TILE_WIDTH) -> DataFrame:
    """Density clusters per chromosome: (chrom, start, copies, core_dist, label), label -1 = noise.

    A position is core when its core distance is at most ``eps``; core positions no further than
    ``eps`` apart share a cluster; a border position joins its nearest core within ``eps`` (the left
    one on a tie); clusters under ``min_cluster_size`` sites become noise. Without ``eps``, the
    given percentile of all core distances is used.
    """
    placed = density_islands(sites, min_samples, eps, eps_percentile, tile_width)
    return label_islands(placed, min_cluster_size, tile_width)


def cluster_extents(labelled: DataFrame) -> DataFrame:
    """Clusters as (chrom, start, end, cluster_id, num_conserved); ``end`` is the last position."""
    return (labelled.where(F.col("label") != -1).groupBy("chrom", "label")
            .agg(F.min("start").alias("start"), F.max("start").alias("end"), F.sum("copies").alias("num_conserved"))
            .select("chrom", "start", "end", F.concat(F.lit("cluster_"), F.col("label").cast("string"))
                    .alias("cluster_id"), "num_conserved"))


def distinct_clusters(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("label") != -1).select("chrom", "label").distinct()


def cluster_summary(clusters: DataFrame, counts: DataFrame, chromes: DataFrame,
                    keys: tuple[str, ...] = ("min_cluster_size", "min_samples")) -> DataFrame:
    """One row per parameter pair: cluster counts, lengths, sites and densities, with genome totals.

    Medians are exact and distributed (see ``exact_quantiles``)."""
    keys = list(keys)
    c = clusters.withColumn("length", F.col("end") - F.col("start")).withColumn(
        "density", F.col("num_conserved") / F.col("length"))
    base = c.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_clusters"), F.sum("length").alias("total_length"),
        F.avg("length").alias("mean_length"), F.sum("num_conserved").alias("sites_in_clusters"),
        F.avg("num_conserved").alias("mean_sites"), F.avg("density").alias("mean_density"))
    for col, name in (("length", "median_length"), ("num_conserved", "median_sites"), ("density", "median_density")):
        base = base.join(exact_quantiles(c, keys, col, {name: 0.5}), keys, "left")
    totals = counts.join(chromes.select("chrom", "length"), "chrom", "left").groupBy().agg(
        F.sum("length").alias("total_sites"), F.sum("n").alias("total_conserved"))
    out = base.withColumn("_one", F.lit(1)).join(totals.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return (out.withColumn("conserved_share", F.col("total_conserved") / F.col("total_sites"))
            .withColumn("share_in_clusters", F.col("sites_in_clusters") / F.col("total_conserved")))
