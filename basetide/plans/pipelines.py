"""End-to-end plans: scores to windows to elements, scores to clusters, elements to loci."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basetide.operators import alignment, cluster, intervals, sites


def conserved(scored: DataFrame, scope: str | None = None, alpha: float = 0.05) -> DataFrame:
    """Raw scores -> significant conserved sites."""
    return sites.conserved_sites(sites.bh_adjust(sites.classify_scores(scored), scope=scope, alpha=alpha))


def conserved_elements(site_table: DataFrame, chromes: DataFrame, width: int, min_sites: int, gap: int = 5) -> DataFrame:
    """Conserved sites -> windows with enough of them (at least one) -> merged elements."""
    counted = intervals.occupied_windows(site_table, chromes, width)
    return intervals.merge_intervals(counted.where(F.col("n") >= min_sites), gap)


def element_grid(site_table: DataFrame, depth: DataFrame, chromes: DataFrame, width: int,
                 depth_cutoffs: Sequence[int], site_cutoffs: Sequence[int], gap: int = 5) -> DataFrame:
    """Elements for every (depth cutoff, site cutoff): sites meet the depth track once, windows are
    counted once per depth cutoff, and every pair of cutoffs is merged in the same pass."""
    deep = intervals.point_join(depth.where(F.col("depth") > min(depth_cutoffs)), site_table)
    each = deep.withColumn("depth_cutoff", F.explode(F.array(*[F.lit(c) for c in depth_cutoffs]))).where(
        F.col("depth") > F.col("depth_cutoff"))
    windows = intervals.occupied_windows(each, chromes, width, keys=["depth_cutoff"])
    passed = windows.withColumn("site_cutoff", F.explode(F.array(*[F.lit(c) for c in site_cutoffs]))).where(
        F.col("n") >= F.col("site_cutoff"))
    return intervals.merge_intervals(passed, gap, keys=("depth_cutoff", "site_cutoff", "chrom"))


def cluster_grid(site_table: DataFrame, sizes: Sequence[int], samples: Sequence[int], eps: float) -> DataFrame:
    """Clusters of every (min_cluster_size, min_samples) pair, as one table; the islands are found
    once per min_samples."""
    frames = []
    for m in samples:
        placed = cluster.density_islands(site_table, m, eps)
        for size in sizes:
            found = cluster.cluster_extents(cluster.label_islands(placed, size))
            frames.append(found.withColumn("min_cluster_size", F.lit(size)).withColumn("min_samples", F.lit(m)))
    return sites.union_all(frames)


def element_loci(blocks: DataFrame, elements: DataFrame, n_species: int, prune: DataFrame | None = None,
                 ref: str = "ref", spans: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Elements -> stitched, de-duplicated, complete and pruned alignments, and their batches."""
    aln = alignment.dedup_species(alignment.fetch_regions(blocks, elements, ref=ref, spans=spans))
    aln = alignment.complete_regions(aln, n_species)
    if prune is not None:
        aln = alignment.prune_species(aln, prune)
    loci = aln.select("chrom", "start", "end", F.col("region_id").alias("name")).distinct()
    return aln, alignment.batch_loci(loci)


__all__ = ["conserved", "conserved_elements", "element_grid", "cluster_grid", "element_loci"]
