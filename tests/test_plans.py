"""Plan checks on the registered queries (the shapes that matter at scale)."""

import re

import pytest

from conftest import SF_SMALL
from rosterline.plans import registry

QUERIES = registry.queries()


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()  # run this DataFrame's own plan so the final adaptive plan is inspected
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _scans(plan, column):
    """Scans of a final plan that read ``column``."""
    final = plan.split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "FileScan parquet" in line and column + "#" in line.split("Batched")[0]]


def test_facility_summary_hash_aggregates_daily_rows(spark):
    plan = _plan(spark, "facility_summary")
    # sort-based aggregates (the maximum of a string) read partial rows, never daily ones
    for line in plan.splitlines():
        if "SortAggregate" in line:
            assert "state" in line and "mdscensus" not in line and "workdate" not in line
    assert "HashAggregate(keys=[provnum" in plan


def test_facility_summary_scans_the_days_once_and_shuffles_no_days(spark):
    plan = _plan(spark, "facility_summary")
    assert len(_scans(plan, "workdate")) == 1 and len(_scans(plan, "mdscensus")) == 1
    for line in plan.splitlines():
        assert "Exchange" not in line or "workdate" not in line


def test_one_facility_lies_in_one_file_of_its_state(spark):
    """A look-up of a facility opens the row groups that may hold it: one, or two at a range's border."""
    import glob

    import pyarrow.parquet as pq

    staffing = registry.Inputs(spark, SF_SMALL.replace("0.001", "0.01")).staffing()
    folders = {}
    for f in staffing.inputFiles():
        folders.setdefault(f.rsplit("/", 1)[0].removeprefix("file:"), []).append(f)
    state = max(folders, key=lambda s: len(folders[s]))
    groups = []
    for f in glob.glob(f"{state}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        column = meta.schema.to_arrow_schema().get_field_index("provnum")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(column).statistics
            groups.append((stats.min, stats.max))
    ids = {r[0] for r in staffing.where(f"state = '{state.rsplit('=', 1)[1]}'").select("provnum").distinct().collect()}
    assert len(ids) > 1
    for i in ids:
        assert 1 <= sum(low <= i <= high for low, high in groups) <= 2


def test_column_pruning_reaches_the_scan(spark):
    plan = _plan(spark, "national_kpis")
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plan)
    cols = {c.split("#")[0] for c in scan.group(1).split(",")}
    assert "provname" not in cols and "hrs_rndon" not in cols and "provnum" in cols


def test_trend_prunes_state_partition(spark):
    plan = _plan(spark, "daily_trend")
    assert re.search(r"PartitionFilters: \[isnotnull\(state#\d+\), \(state#\d+ = NATION_9\)\]", plan)
    assert "PushedFilters: [IsNotNull(provnum), EqualTo(provnum,10)]" in plan


def test_state_slice_prunes_published_analytics(spark):
    assert "(state#" in _plan(spark, "top_facilities").split("PartitionFilters: ")[1].split("]")[0]


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "top_facilities")
    assert "TakeOrderedAndProject" in _plan(spark, "state_ranking")


def test_written_dimension_is_broadcast_by_its_size(spark):
    plan = _plan(spark, "enrich_left")
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
