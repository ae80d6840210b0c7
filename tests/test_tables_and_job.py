"""Parquet table store: creation, keyed upserts, status, the batch job and the CSV path."""

import os

import pytest

from pyspark.sql import functions as F

from ebbflow import operators as op
from ebbflow.plans.job import run_batch
from ebbflow.sources import FlowTables, read_trips_csv, read_trips_csv_inferred, shape_of, write_trips_csv
from tests.helpers import rows, trip, trips_df


def test_create_is_idempotent_and_status(spark, tmp_dir):
    t = FlowTables(spark, tmp_dir).create().create()
    assert rows(t.status()) == [("events_hourly", 0), ("station", 0)]


def test_status_of_missing_tables(spark, tmp_dir):
    t = FlowTables(spark, os.path.join(tmp_dir, "none"))
    assert rows(t.status()) == [("events_hourly", 0), ("station", 0)]


def test_upsert_stations_rules(spark, tmp_dir):
    t = FlowTables(spark, tmp_dir).create()
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp")
    t1 = F.lit("2024-02-01 00:00:00").cast("timestamp")
    first = spark.createDataFrame([("S1", "One", 15, 0), ("S2", "Two", 10, 1)], "id string, name string, capacity int, is_active int")
    t.upsert_stations(first, t0)
    second = spark.createDataFrame([("S1", "Uno"), ("S3", "Three")], "id string, name string")
    got = t.upsert_stations(second, t1)
    r = {x["id"]: (x["name"], x["capacity"], x["is_active"], str(x["created_at_utc"])) for x in got.collect()}
    assert r == {
        "S1": ("Uno", None, 1, "2024-01-01 00:00:00"),  # capacity overwritten by NULL, is_active by 1, created kept
        "S2": ("Two", 10, 1, "2024-01-01 00:00:00"),
        "S3": ("Three", None, 1, "2024-02-01 00:00:00"),
    }


def test_upsert_deltas_replace_is_idempotent(spark, tmp_dir):
    t = FlowTables(spark, tmp_dir).create()
    old = spark.createDataFrame(
        [("2024-01-01 10:00:00", "A", 3), ("2024-01-01 11:00:00", "A", 1), ("2024-01-02 10:00:00", "B", 2)],
        "hour string, station_id string, delta_total long")
    t.upsert_deltas(old)
    new = spark.createDataFrame([("2024-01-01 10:00:00", "A", -5), ("2024-01-03 00:00:00", "C", 4)],
                                "hour string, station_id string, delta_total long")
    t.upsert_deltas(new)
    once = rows(t.deltas(), "hour", "station_id", "delta_total")
    t.upsert_deltas(new)
    assert rows(t.deltas(), "hour", "station_id", "delta_total") == once == [
        ("2024-01-01 10:00:00", "A", -5), ("2024-01-01 11:00:00", "A", 1),
        ("2024-01-02 10:00:00", "B", 2), ("2024-01-03 00:00:00", "C", 4)]
    assert rows(t.deltas(until="2024-01-01 23:00:00"), "hour") == [("2024-01-01 10:00:00",), ("2024-01-01 11:00:00",)]


def test_merge_add_mode(spark):
    old = spark.createDataFrame([("h", "A", 3)], "hour string, station_id string, delta_total long")
    new = spark.createDataFrame([("h", "A", 2), ("h", "B", 1)], "hour string, station_id string, delta_total long")
    assert rows(op.merge_deltas(old, new, "add")) == [("h", "A", 5), ("h", "B", 1)]


def sample_trips(spark):
    return trips_df(spark, [
        trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:20:00", "S1", "S2", "One", "Two"),
        trip("r2", "2024-01-01 10:30:00", "2024-01-01 11:20:00", "S2", "S1", "Two", "One"),
        trip("r3", "2024-01-01 12:00:00", "2024-01-01 11:00:00", "S2", "S3", "Two", "Three"),
        trip("r4", "2024-01-01 12:00:00", "2024-01-01 12:05:00", " ", "S3", None, "Three"),
    ])


def test_run_batch_twice_is_idempotent(spark, tmp_dir):
    s1 = run_batch(spark, sample_trips(spark), tmp_dir, F.lit("2024-01-05 00:00:00").cast("timestamp")).collect()[0]
    s2 = run_batch(spark, sample_trips(spark), tmp_dir, F.lit("2024-01-06 00:00:00").cast("timestamp")).collect()[0]
    assert (s1["trips"], s1["stations"], s1["hourly_events"]) == (3, 3, 4)
    assert s1 == s2
    t = FlowTables(spark, tmp_dir)
    assert {r["id"]: str(r["created_at_utc"]) for r in t.stations().collect()}["S1"] == "2024-01-05 00:00:00"


def test_run_batch_counts_its_own_load(spark, tmp_dir):
    run_batch(spark, sample_trips(spark), tmp_dir)
    more = trips_df(spark, [trip("r9", "2024-01-03 10:00:00", "2024-01-03 10:20:00", "S1", "S4", "One", "Four")])
    s = run_batch(spark, more, tmp_dir).collect()[0]
    assert (s["trips"], s["stations"], s["hourly_events"], s["analysed"]) == (1, 2, 2, 4)
    assert rows(FlowTables(spark, tmp_dir).status()) == [("events_hourly", 6), ("station", 4)]


def test_run_batch_scans_its_input_once(spark, tmp_dir):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    trips = sample_trips(spark)
    run_batch(spark, trips.mapInArrow(seen, trips.schema), tmp_dir)
    assert read.value == trips.count()


def test_failed_load_leaves_the_old_state(spark, tmp_dir):
    t = FlowTables(spark, tmp_dir).create()
    schema = "hour string, station_id string, delta_total long"
    t.upsert_deltas(spark.createDataFrame([("2024-01-01 10:00:00", "A", 3), ("2024-01-02 10:00:00", "A", 1)], schema))
    before = rows(t.deltas(), "hour", "station_id", "delta_total")
    new = spark.createDataFrame([("2024-01-01 10:00:00", "A", 9), ("2024-01-05 10:00:00", "B", 2)], schema)

    class Crash(FlowTables):
        def _write_days(self, merged):
            super()._write_days(merged.limit(1))  # half of the days land
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        Crash(spark, tmp_dir).upsert_deltas(new)
    assert rows(t.deltas(), "hour", "station_id", "delta_total") == before
    t.upsert_deltas(new)
    after = [("2024-01-01 10:00:00", "A", 9), ("2024-01-02 10:00:00", "A", 1), ("2024-01-05 10:00:00", "B", 2)]
    assert rows(t.deltas(), "hour", "station_id", "delta_total") == after
    assert t.vacuum_deltas() == 2  # the half load and the replaced day
    assert rows(t.deltas(), "hour", "station_id", "delta_total") == after


def test_exploratory_flows_keep_legs_of_rejected_trips(spark):
    norm = op.normalise_trips(sample_trips(spark))
    assert dict(rows(op.net_flow_by_station(norm), "station_id", "difference")) == {"S1": 0, "S2": 1, "S3": -2}
    assert ("S3", -2) in rows(op.daily_net_flow(norm), "station_id", "difference")


def test_one_event_without_digits_does_not_fail(spark):
    from ebbflow.sources import events_as_trips

    e = spark.sql("SELECT 10L event_id, TIMESTAMP_NTZ'2024-01-01 10:00:00' ts, 1L user_id, 'click' event_type, 1.5D value, '{}' props")
    assert op.clean_trips(events_as_trips(e)).select("start_station_id").first()[0] is None


def test_csv_round_trip_with_bad_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    write_trips_csv(sample_trips(spark), path)
    extra = os.path.join(path, "zz-bad.csv")
    with open(extra, "w") as f:
        f.write("ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,"
                "end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n")
        f.write("b1,classic_bike,garbage,2024-01-01 10:00:00,A,S1,B,S2,,,,,member\n")  # unparsable time
        f.write("b2,classic_bike,2024-01-01 10:00:00\n")  # short row
        f.write('b3,classic_bike,2024-01-01 10:00:00.250,2024-01-01 10:30:00,"Name, with comma",S9,B,\t,,,,,member\n')
    back = read_trips_csv(spark, path)
    assert back.count() == 7
    d = rows(op.hourly_deltas(op.clean_trips(back)), "hour", "station_id", "delta_total")
    assert ("2024-01-01 10:00:00", "S9", -1) in d and ("2024-01-01 10:00:00", "\t", 1) in d
    names = {r["station_name"] for r in op.station_catalog(op.clean_trips(back)).collect()}
    assert "Name, with comma" in names
    shape = shape_of(read_trips_csv_inferred(spark, path)).collect()[0]
    assert (shape["rows"], shape["columns"]) == (7, 13)


def test_vacuum_keeps_current_station_version(spark, tmp_dir):
    t = FlowTables(spark, tmp_dir).create()
    for name in ("One", "Uno", "Eins"):
        t.upsert_stations(spark.createDataFrame([("S1", name)], "id string, name string"))
    assert t.vacuum_stations(keep=1) == 2
    assert [(r["id"], r["name"]) for r in t.stations().collect()] == [("S1", "Eins")]
    assert t.vacuum_stations(keep=1) == 0
    t.upsert_stations(spark.createDataFrame([("S2", "Two")], "id string, name string"))
    assert rows(t.stations(), "id", "name") == [("S1", "Eins"), ("S2", "Two")]
