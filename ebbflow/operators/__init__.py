"""DataFrame → DataFrame operators for signed flow between keyed places over time."""

from ebbflow.operators.balance import (
    active_stations,
    adjustment_totals,
    balance_from_flow,
    balance_from_trips,
    flow_by_name,
    balance_of_station,
    balances_as_of,
    balances_at_step,
    carry_over_at,
    carry_over_balance,
    flow_totals,
    hour_at_step,
    hour_index,
    latest_balance,
    overall_balance,
    running_balance,
    station_balance,
    station_events_range,
    with_adjustments,
)
from ebbflow.operators.clean import (
    clean_trips,
    is_usable_trip,
    is_valid_trip,
    normalise_trips,
    usable_trips,
    valid_trips,
)
from ebbflow.operators.deltas import (
    arrivals_departures,
    bucketed_deltas,
    class_flow_by_name,
    daily_net_flow,
    flow_with_counts,
    hourly_deltas,
    net_flow_by_station,
)
from ebbflow.operators.insight import (
    above_initial_top,
    balance_alerts,
    balance_histogram,
    balance_labels,
    balance_stats,
    balance_stats_by_selection,
    below_initial_top,
    critical_stations,
    day_top,
    flow_run_summary,
    median_by_selection,
    rebalancing_summary,
    run_summary,
    surplus_deficit_top,
    top_per_day,
    worst_station,
)
from ebbflow.operators.legs import flow_legs, station_catalog, station_name_pairs
from ebbflow.operators.profile import (
    bike_type_counts,
    distinct_station_counts,
    flow_status,
    null_station_by_type,
    null_station_summary,
    orphan_station_events,
    row_counts,
    station_flow_totals,
    trip_date_range,
    trip_sample,
    unnamed_stations,
    usable_trip_summary,
)
from ebbflow.operators.snapshots import balance_within_days, day_nets, day_totals, running_balance_by_day, totals_at, with_day
from ebbflow.operators.upsert import merge_deltas, merge_stations

__all__ = [name for name in dir() if not name.startswith("_")]
