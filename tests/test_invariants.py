"""Invariants between redundant formulations, on the adapter-A trips of the shared test tables."""

import pytest
from pyspark.sql import functions as F

from ebbflow import operators as op
from ebbflow.plans import catalog as q
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def data(spark):
    clean = op.clean_trips(q.raw_trips(spark, SF_SMALL)).cache()
    deltas = op.hourly_deltas(clean, by_class=True).cache()
    stations = q.stations(spark, SF_SMALL)
    yield clean, deltas, stations
    clean.unpersist()
    deltas.unpersist()


def as_map(df, key, value):
    return {tuple(r[k] for k in key): r[value] for r in df.collect()}


def test_union_sum_equals_arrivals_minus_departures(data):
    clean, deltas, _ = data
    ad = op.arrivals_departures(clean)
    assert as_map(deltas, ("hour", "station_id"), "delta_total") == as_map(ad, ("hour", "station_id"), "delta")


def test_class_split_sums_to_total(data):
    _, deltas, _ = data
    assert deltas.where(F.col("delta_ebike") + F.col("delta_other") != F.col("delta_total")).count() == 0


def test_total_flow_equals_legs(data):
    clean, deltas, _ = data
    arrivals = clean.where(F.col("end_station_id").isNotNull()).count()
    departures = clean.where(F.col("start_station_id").isNotNull()).count()
    assert deltas.agg(F.sum("delta_total")).first()[0] == arrivals - departures


def test_as_of_last_hour_equals_overall(data):
    _, deltas, stations = data
    last = deltas.agg(F.max("hour")).first()[0]
    overall = as_map(op.overall_balance(stations, deltas), ("station_id",), "final_balance")
    as_of = as_map(op.balances_as_of(stations, deltas, last), ("station_id",), "balance")
    assert overall == as_of


def test_last_running_balance_equals_overall(data):
    _, deltas, stations = data
    overall = as_map(op.overall_balance(stations, deltas), ("station_id",), "final_balance")
    latest = as_map(op.latest_balance(op.running_balance(deltas)), ("station_id",), "balance")
    for k, v in latest.items():
        if k in overall:
            assert overall[k] == v


def test_daily_equals_hourly_by_date(data):
    clean, deltas, _ = data
    daily = as_map(op.daily_net_flow(clean).select(F.col("date").cast("string").alias("date"), "station_id", "difference"),
                   ("date", "station_id"), "difference")
    by_date = deltas.groupBy(F.substring("hour", 1, 10).alias("date"), "station_id").agg(
        (-F.sum("delta_total")).alias("difference"))
    assert daily == as_map(by_date, ("date", "station_id"), "difference")


def test_orphans_are_ids_without_names(data):
    clean, deltas, stations = data
    orphans = {r["station_id"] for r in op.orphan_station_events(deltas, stations).collect()}
    assert len(orphans) == 6
    assert orphans.isdisjoint({r["id"] for r in stations.collect()})


def test_fixture_sizes(data):
    clean, deltas, stations = data
    assert clean.count() == 9163
    assert deltas.count() == 15384
    assert stations.count() == 94


def test_one_aggregate_summaries_equal_table_forms(spark, data):
    clean, deltas, stations = data
    flow = op.flow_with_counts(clean)
    anti = {(r["station_id"], r["rows"]) for r in op.orphan_station_events(deltas, stations).collect()}
    assert {(r["station_id"], r["rows"]) for r in op.unnamed_stations(flow).collect()} == anti
    from ebbflow.sources import active_flag

    catalog = op.station_catalog(clean)
    balances = op.overall_balance(stations, deltas)
    table_form = op.run_summary(clean, catalog, deltas, balances).collect()[0].asDict()
    one_pass = op.flow_run_summary(flow, member=active_flag() == 1).collect()[0].asDict()
    assert one_pass == table_form
    assert flow.agg(F.sum("trips")).first()[0] == clean.count()
