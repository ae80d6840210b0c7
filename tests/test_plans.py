"""Plan-level checks: the properties the design relies on at scale, asserted on the physical plans."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry_module
from ebbflow.plans import QUERIES
from ebbflow.plans import catalog as q
from tests.conftest import SF_SMOKE

# queries that start a stream or write scratch files when called; their batch plans are covered elsewhere
SIDE_EFFECTS = {"stream_hourly_deltas", "stream_balance", "stream_station_pairs", "csv_round_trip", "csv_inferred_shape", "batch_job"}


def plan_text(df, executed=False) -> str:
    if executed:
        df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan_text(entry_module.queries()[name](spark, SF_SMOKE))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, f"{name} plans a {bad}"


def test_hourly_deltas_prunes_columns_and_combines_map_side(spark):
    text = plan_text(q.deltas(spark, SF_SMOKE))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double,props:string>" in text
    assert "user_id" not in text.split("ReadSchema")[1].split("\n")[0]
    assert "partial_sum" in text  # map-side combine before the shuffle


def test_catalog_hash_reduces_legs_before_string_min(spark):
    text = plan_text(q.catalog(spark, SF_SMOKE), executed=True)
    tree = text.split("== Initial Plan ==")[0]
    # the first aggregate above the scan is a hash aggregate; the sort aggregate only sees reduced pairs
    lines = [l for l in tree.splitlines() if "Aggregate" in l]
    assert "HashAggregate" in lines[-1]


def test_running_balance_window_partitioned_by_station(spark):
    from ebbflow import operators as op

    text = plan_text(op.running_balance(q.deltas(spark, SF_SMOKE)))
    assert "Window" in text and "SinglePartition" not in text


def test_hour_index_has_no_global_window_over_rows(spark):
    from ebbflow import operators as op

    text = plan_text(op.hour_index(q.deltas(spark, SF_SMOKE)))
    # the only single-partition exchange carries one row per day: it reads the rows numbered 0 within their day
    assert text.count("SinglePartition") == 1
    node = [l for l in text.splitlines() if re.match(r"\(\d+\) Exchange|Input|Arguments", l)]
    at = next(i for i, l in enumerate(node) if "SinglePartition" in l)
    assert "hour#" not in node[at - 1] and "_day#" in node[at - 1]


def test_histogram_reuses_balance_subtree(spark):
    text = plan_text(entry_module.queries()["balance_histogram"](spark, SF_SMOKE), executed=True)
    assert "ReusedExchange" in text or "ReusedSubquery" in text


def test_table_reads_prune_partitions(spark, tmp_dir):
    from ebbflow.sources import FlowTables

    t = FlowTables(spark, tmp_dir).create()
    t.upsert_deltas(q.deltas(spark, SF_SMOKE))
    text = plan_text(t.deltas(until="2024-01-10 05:00:00"))
    assert "PartitionFilters: [isnotnull(date" in text and "<= 2024-01-10" in text


@pytest.mark.parametrize(
    "name",
    ["balance_histogram", "worst_station_series", "balance_carry_over", "hour_at_step", "run_summary",
     "table_status", "orphan_station_events", "surplus_deficit_top", "station_balance", "balances_as_of"],
)
def test_multi_branch_queries_scan_trips_once(spark, name):
    text = plan_text(entry_module.queries()[name](spark, SF_SMOKE), executed=True)
    final_tree = text.split("== Initial Plan ==")[0]
    assert final_tree.count("Scan parquet") == 1, f"{name} scans its input more than once"


@pytest.mark.parametrize("name", ["balances_adjusted", "balance_alerts", "below_initial_top", "above_initial_top", "balance_labels"])
def test_adjusted_queries_scan_trips_once_and_adjustments_once(spark, name):
    text = plan_text(entry_module.queries()[name](spark, SF_SMOKE), executed=True)
    assert text.split("== Initial Plan ==")[0].count("Scan parquet") == 2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_no_fixed_count_repartition(spark, name):
    assert "REPARTITION_BY_NUM" not in plan_text(QUERIES[name](spark, SF_SMOKE))


@pytest.mark.parametrize("name", ["balance_of_station", "station_events_range", "station_events_until"])
def test_hour_bound_reaches_the_scan_of_raw_trips(spark, name):
    assert "LessThan(ts" in plan_text(QUERIES[name](spark, SF_SMOKE))


@pytest.mark.parametrize("name", ["table_station_range", "table_hourly_events", "table_balances_as_of"])
def test_table_queries_read_pruned_days_and_no_trips(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMOKE))
    assert "PartitionFilters: [isnotnull(date" in text and "events.parquet" not in text
