"""Balances, thresholds, rankings, histogram and hour stepping on literal frames."""

import pytest
from pyspark.sql import functions as F

from ebbflow import operators as op


def stations(spark, ids, inactive=()):
    data = [(i, f"Name {i}", None, 0 if i in inactive else 1, None) for i in ids]
    return spark.createDataFrame(data, "id string, name string, capacity int, is_active int, created_at_utc timestamp")


def deltas(spark, data):
    return spark.createDataFrame(data, "hour string, station_id string, delta_total long")


def test_balance_as_of_keeps_stations_without_flow(spark):
    st = stations(spark, ["A", "B", "C"], inactive=("C",))
    d = deltas(spark, [("2024-01-01 10:00:00", "A", -3), ("2024-01-01 12:00:00", "A", 5), ("2024-01-01 10:00:00", "X", 7)])
    got = {r["station_id"]: r["balance"] for r in op.balances_as_of(st, d, "2024-01-01 11:00:00").collect()}
    assert got == {"A": 17, "B": 20}  # inactive C and orphan X are not listed


def test_adjustments_summed_and_zero_kept(spark):
    st = stations(spark, ["A", "B"])
    d = deltas(spark, [("2024-01-01 10:00:00", "A", -3)])
    adj = spark.createDataFrame([("A", 2), ("A", 0), ("A", 1), ("Z", 9)], "station_id string, amount long")
    got = {r["station_id"]: r["balance"] for r in op.station_balance(st, d, adjustments=adj).collect()}
    assert got == {"A": 20, "B": 20}


def test_unknown_station_has_initial_balance(spark):
    d = deltas(spark, [("2024-01-01 10:00:00", "A", -3)])
    assert op.balance_of_station(d, "none", "2024-01-02 00:00:00").collect()[0]["balance"] == 20


def test_running_balance_and_latest(spark):
    d = deltas(spark, [("2024-01-01 10:00:00", "A", -3), ("2024-01-01 11:00:00", "A", 5), ("2024-01-01 12:00:00", "A", -4)])
    rb = op.running_balance(d)
    assert [r["balance"] for r in rb.orderBy("hour").collect()] == [17, 22, 18]
    latest = op.latest_balance(rb).collect()[0]
    # the latest balance, not the largest (22)
    assert (latest["hour"], latest["balance"]) == ("2024-01-01 12:00:00", 18)


def test_carry_over_equals_running_balance(spark):
    d = deltas(spark, [("2024-01-01 %02d:00:00" % h, "A", h % 3 - 1) for h in range(10)])
    full = {(r["hour"], r["balance"]) for r in op.running_balance(d).collect()}
    before = op.running_balance(d.where(F.col("hour") < "2024-01-01 05:00:00"))
    after = op.carry_over_balance(d.where(F.col("hour") >= "2024-01-01 05:00:00"), before)
    assert {(r["hour"], r["balance"]) for r in after.collect()} <= full
    assert after.count() == 5
    one_table = op.carry_over_at(d, "2024-01-01 05:00:00")
    assert {(r["hour"], r["balance"]) for r in one_table.collect()} == {(r["hour"], r["balance"]) for r in after.collect()}


def test_hour_index_and_clamp(spark):
    hours = [f"2024-01-{d:02d} {h:02d}:00:00" for d in (1, 2, 3) for h in (0, 5, 23)]
    d = deltas(spark, [(h, "A", 1) for h in hours])
    idx = sorted((r["hour_index"], r["hour"]) for r in op.hour_index(d).collect())
    assert idx == list(enumerate(sorted(hours)))
    assert op.hour_at_step(d, start=2, steps=3).collect()[0]["hour"] == sorted(hours)[5]
    assert op.hour_at_step(d, start=16, steps=6).collect()[0]["hour_index"] == 8  # clamped


@pytest.mark.parametrize("inclusive,expected", [(True, {("low", "A"), ("high", "B")}), (False, set())])
def test_threshold_edges(spark, inclusive, expected):
    b = spark.createDataFrame([("A", "a", -15, 5), ("B", "b", 10, 30), ("C", "c", 0, 20)],
                              "station_id string, station_name string, net_change long, final_balance long")
    got = {(r["kind"], r["station_id"]) for r in op.critical_stations(b, inclusive=inclusive).collect()}
    assert got == expected


def test_alert_message(spark):
    b = spark.createDataFrame([("A", "Alpha", 3), ("B", "Beta", 31), ("C", "Gamma", 5)],
                              "station_id string, station_name string, balance long")
    got = {(r["kind"], r["message"]) for r in op.balance_alerts(b).collect()}
    assert got == {("low", "Alpha — 3 bikes"), ("high", "Beta — 31 bikes")}


def test_rebalancing_summary_empty_is_zero(spark):
    b = spark.createDataFrame([("C", "c", 0, 20)], "station_id string, station_name string, net_change long, final_balance long")
    r = op.rebalancing_summary(b).collect()[0]
    assert (r["low_count"], r["high_count"], r["deficit"], r["surplus"], r["net"]) == (0, 0, 0, 0, 0)


def test_histogram_matches_numpy(spark):
    np = pytest.importorskip("numpy")
    values = [-12, -3, 0, 0, 4, 7, 19, 20, 20, 33, 63]
    b = spark.createDataFrame([(f"S{i}", v) for i, v in enumerate(values)], "station_id string, final_balance long")
    got = sorted((r["bin"], r["stations"], r["bin_lo"]) for r in op.balance_histogram(b).collect())
    counts, edges = np.histogram(values, bins=50)
    assert [g[1] for g in got] == list(counts)
    assert [g[2] for g in got] == [round(e, 6) for e in edges[:-1]]


def test_histogram_constant_values_in_middle_bin(spark):
    b = spark.createDataFrame([("A", 7), ("B", 7)], "station_id string, final_balance long")
    got = {r["bin"]: r["stations"] for r in op.balance_histogram(b).collect() if r["stations"]}
    assert got == {25: 2}


def test_top_k_ties_by_station_id(spark):
    b = spark.createDataFrame([(f"S{i}", "n", 0) for i in range(15)], "station_id string, station_name string, net_change long")
    got = op.surplus_deficit_top(b, k=3).collect()
    assert [r["station_id"] for r in got] == ["S0", "S1", "S10", "S9", "S8", "S7"]


def test_labels(spark):
    b = spark.createDataFrame([("A", 19), ("B", 20), ("C", 21)], "station_id string, balance long")
    assert {r["station_id"]: r["status"] for r in op.balance_labels(b).collect()} == {
        "A": "below", "B": "equal", "C": "above"}
