"""Plan shapes: no nested-loop or cartesian joins, no one-task windows over data, pruned scans."""

import pytest

import __spark_entry__ as entry
from basetide import adapters as A
from basetide.operators import intervals, sites

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["overlap_pairs", "overlap_counts", "merged_intervals", "conserved_sites", "bh_per_chrom",
                                  "window_site_counts", "fetched_regions", "dedup_alignments", "ks_uniform", "element_grid"])
def test_no_nested_loop_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_scans_are_pruned(spark):
    text = plan(sites.classify_scores(A.sites(spark, SF)))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text


def test_chromosome_windows_run_over_tiles(spark):
    text = plan(intervals.merge_intervals(A.intervals(spark, SF), 5))
    wide = [line for line in text.splitlines() if "hashpartitioning(chrom" in line and "Exchange" in line]
    assert wide
    # exchanges on the chromosome alone only feed the window over tile summaries
    summaries = text.count("hashpartitioning(chrom#")
    assert summaries >= 1 and "_tile" in text


@pytest.mark.parametrize("name", ["fetched_regions", "fourfold_columns", "concatenated_blocks"])
def test_interval_joins_move_coordinates_only(spark, name):
    """Whole block rows pass no exchange that is keyed on the bins of the interval join, also where nothing is broadcast."""
    df = entry.queries()[name](spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        exchanges = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(_chrom" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert exchanges
    text = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    binned = [line for line in text if "_bin#" in line and "Project" in line]
    assert binned and not any("rows#" in line for line in binned)


def test_alignment_columns_are_counted_once(spark):
    assert plan(entry.queries()["site_patterns"](spark, SF)).count("MapInPandas") == 0


def test_dedup_limits_ranks_in_map_tasks_and_aggregates_no_sequence(spark):
    from basetide.operators import alignment

    aln = spark.createDataFrame([("r", "s", 0, 0, 0, "AC-")], "region_id string, species string, first_block long, first_row int, copy int, seq string")
    plan = alignment.dedup_species(aln)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
