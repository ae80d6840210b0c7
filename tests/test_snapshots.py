"""Day totals, two-level running sums, cascade delete, ledger, layout, quarantine, selection."""

import os
import random
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ebbflow import operators as op
from ebbflow.plans import catalog as q
from ebbflow.plans.job import run_batch
from ebbflow.sources import FlowTables, read_trips_csv, read_trips_csv_quarantine, station_table, write_trips_csv
from ebbflow.sources.tables import CHANGES, EVENTS_HOURLY
from tests.conftest import SF_SMOKE
from tests.helpers import rows

FLOW = "hour string, station_id string, delta_total long"


def flow(spark, *given):
    return spark.createDataFrame(list(given), FLOW)


def made(days=9, stations=7, seed=1):
    rng = random.Random(seed)
    return [(f"2024-03-{d:02d} {h:02d}:00:00", f"S{s}", rng.randrange(-3, 4)) for d in range(1, days + 1) for s in range(stations) for h in sorted(rng.sample(range(24), rng.randrange(4)))]


def balance_at(given, hour, initial=20):
    out = defaultdict(lambda: initial)
    for h, s, n in given:
        out[s] += n if h <= hour else 0
    return out


def stored(spark, root, given):
    t = FlowTables(spark, root).create()
    names = spark.createDataFrame([(f"S{i}", f"Name {i}") for i in range(7)], "station_id string, station_name string")
    t.upsert_stations(station_table(names).withColumn("is_active", F.lit(1)))
    t.upsert_deltas(flow(spark, *given))
    return t


def test_day_totals_hold_every_station_on_every_later_day(spark):
    got = rows(op.day_totals(op.day_nets(flow(spark, ("2024-03-01 08:00:00", "A", 2), ("2024-03-03 08:00:00", "A", -1), ("2024-03-02 09:00:00", "B", 5)))))
    assert sorted((str(d), s, n) for d, s, n in got) == [("2024-03-01", "A", 2), ("2024-03-02", "A", 2), ("2024-03-02", "B", 5), ("2024-03-03", "A", 1), ("2024-03-03", "B", 5)]
    assert op.day_totals(op.day_nets(flow(spark))).count() == 0


def test_two_level_running_balance(spark):
    d = flow(spark, *made(), *[(f"2024-03-05 {i // 60:02d}:{i % 60:02d}:00", "HOT", 1) for i in range(1200)])  # one hot station, minute grain
    assert rows(op.running_balance_by_day(d)) == rows(op.running_balance(d))
    plan = op.running_balance_by_day(d)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "windowspecdefinition" in line and "Window " in line]
    assert any("windowspecdefinition(station_id" in w and "date" in w.split("windowspecdefinition(")[1].split(" ASC")[0] for w in windows)
    assert all("hour" not in w.split("windowspecdefinition(")[1] or "date" in w.split("windowspecdefinition(")[1] for w in windows)  # hours only inside a day


def test_balances_at_every_kind_of_hour(spark, tmp_dir):
    given = made()
    t = stored(spark, os.path.join(tmp_dir, "t"), given)
    hours = ["2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-03-04 11:00:00", "2024-03-09 23:00:00", "2024-05-01 00:00:00"]

    def check(all_rows):
        for hour in hours:
            want = balance_at(all_rows, hour)
            assert {r["station_id"]: r["balance"] for r in t.balances_as_of(hour).collect()} == {f"S{i}": want[f"S{i}"] for i in range(7)}

    check(given)  # nothing summed up yet
    t.snapshot_totals()
    check(given)
    late = [("2024-03-02 23:30:00", "S1", 4), ("2024-03-04 11:30:00", "S2", -2), ("2024-03-20 01:00:00", "S3", 9), ("2024-02-27 05:00:00", "S4", 1)]
    t.upsert_deltas(flow(spark, *late), mode="add")
    check(given + late)
    replaced = [(h, s, 7) for h, s, _ in given[:5]]
    t.upsert_deltas(flow(spark, *replaced))
    given = replaced + given[5:]
    check(given + late)
    t.vacuum_deltas()
    check(given + late)
    t.snapshot_totals()
    assert t.changes(-1).count() == 0
    check(given + late)


def test_one_day_and_one_snapshot_are_read(spark, tmp_dir):
    t = stored(spark, os.path.join(tmp_dir, "t"), made())
    t.snapshot_totals()
    files = t.balances_as_of("2024-03-04 11:00:00").inputFiles()
    totals = {f.split("date=")[1].split("/")[0] for f in files if "station_day_totals" in f}
    assert totals == {"2024-03-03"}
    plan = t.balances_as_of("2024-03-04 11:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "2024-03-04" in plan and "PartitionFilters" in plan and "(date#" in plan


def test_a_load_that_fails_changes_no_balance(spark, tmp_dir, monkeypatch):
    given = made()
    t = stored(spark, os.path.join(tmp_dir, "t"), given)
    t.snapshot_totals()

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(FlowTables, "_write_manifest", fail)
        with pytest.raises(OSError):
            t.upsert_deltas(flow(spark, ("2024-03-02 01:00:00", "S1", 99)), mode="add")
        with pytest.raises(OSError):
            t.delete_stations(spark.createDataFrame([("S1",)], "id string"))
    assert len(t._numbers(CHANGES)) == 2  # both are there, and count for nothing
    late = [("2024-03-05 02:30:00", "S0", 3)]
    for extra in ([], late):
        if extra:
            t.upsert_deltas(flow(spark, *extra), mode="add")
        want = balance_at(given + extra, "2024-03-06 00:00:00")
        assert {r["station_id"]: r["balance"] for r in t.balances_as_of("2024-03-06 00:00:00").collect()} == {f"S{i}": want[f"S{i}"] for i in range(7)}
        assert t.stations().count() == 7
    assert t.vacuum_stations(keep=1) == 1 and t.stations().count() == 7  # the half-deleted version goes


def test_cascade_delete(spark, tmp_dir):
    given = made()
    t = stored(spark, os.path.join(tmp_dir, "t"), given)
    t.snapshot_totals()
    before = {r["date"]: r["load"] for r in t.manifest().collect()}
    only = flow(spark, ("2024-04-01 01:00:00", "S6", 1))
    t.upsert_deltas(only)  # a day that the delete does not touch
    t.delete_stations(spark.createDataFrame([("S1",), ("S2",), ("S2",), ("nobody",), (None,)], "id string"))
    left = [r for r in given if r[1] not in ("S1", "S2")] + [("2024-04-01 01:00:00", "S6", 1)]
    assert sorted(rows(t.deltas(), "hour", "station_id", "delta_total")) == sorted(left)
    assert sorted(r["id"] for r in t.stations().collect()) == ["S0", "S3", "S4", "S5", "S6"]
    assert {str(r["date"]): r["load"] for r in t.manifest().collect()}["2024-04-01"] == 1 and set(before.values()) == {0}
    want = balance_at(left, "2024-03-07 12:00:00")
    assert {r["station_id"]: r["balance"] for r in t.balances_as_of("2024-03-07 12:00:00").collect()} == {s: want[s] for s in ("S0", "S3", "S4", "S5", "S6")}


def test_a_station_reads_few_row_groups(spark, tmp_dir):
    """Within a day the files hold ranges of stations, and every station has a bloom filter."""
    given = [(f"2024-03-01 {h:02d}:00:00", f"S{s:04d}", 1) for s in range(600) for h in range(10)]
    t = FlowTables(spark, os.path.join(tmp_dir, "t")).create()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with days of more than one partition's size
    try:
        t.upsert_deltas(flow(spark, *given).repartition(8))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = []
    for folder, _, names in os.walk(t.path(EVENTS_HOURLY)):
        for name in names:
            if name.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, name)).metadata
                for g in range(meta.num_row_groups):
                    column = next(meta.row_group(g).column(c) for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == "station_id")
                    found.append((column.statistics.min, column.statistics.max))
    found.sort()
    assert len(found) > 1 and all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))  # ranges that do not overlap
    assert sum(low <= "S0123" <= high for low, high in found) <= 2
    plan = t.deltas(station="S0123")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(station_id,S0123)" in plan and t.deltas(station="S0123").count() == 10


def test_files_are_added_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    write_trips_csv(q.raw_trips(spark, SF_SMOKE), path)
    t = FlowTables(spark, os.path.join(tmp_dir, "t")).create()
    read = lambda files: read_trips_csv(spark, files)
    n = len([f for f in os.listdir(path) if f.endswith(".csv")])
    assert (t.add_trip_files(path, read), t.add_trip_files(path, read)) == (n, 0)
    want = rows(q.deltas(spark, SF_SMOKE), "hour", "station_id", "delta_total")
    assert rows(t.deltas(), "hour", "station_id", "delta_total") == want
    more = os.path.join(path, "part-more.csv")
    first = next(f for f in sorted(os.listdir(path)) if f.endswith(".csv"))
    with open(os.path.join(path, first)) as a, open(more, "w") as b:
        b.writelines(a.readlines()[:50])
    assert t.add_trip_files(path, read) == 1
    assert t.deltas().agg(F.sum(F.abs("delta_total"))).first()[0] is not None and t.add_trip_files(path, read) == 0


def test_quarantine(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    os.makedirs(path)
    head = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
    good = "R1,classic_bike,2024-01-01 08:00:00,2024-01-01 09:00:00,One,S1,Two,S2,1.0,2.0,3.0,4.0,member"
    bad = ["R2,classic_bike,yesterday,2024-01-01 09:00:00,One,S1,Two,S2,1.0,2.0,3.0,4.0,member", "R3,classic_bike,2024-01-01 08:00:00", good.replace("R1", "R4").replace("3.0", "north")]
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("\n".join([head, good, *bad, ""]))
    trips, unread = read_trips_csv_quarantine(spark, path)
    assert [r["ride_id"] for r in trips.collect()] == ["R1"] and trips.count() == 1 and trips.select("ride_id").count() == 1
    assert sorted(r["record"] for r in unread.collect()) == sorted(bad) and {r["file_name"] for r in unread.collect()} == {"a.csv"}
    kept = os.path.join(tmp_dir, "unread")
    row = run_batch(spark, path, os.path.join(tmp_dir, "t"), quarantine=kept).first()
    assert row["trips"] == 1 and row["quarantined"] == 3 and spark.read.parquet(kept).count() == 3


@pytest.mark.parametrize("values", [[], [3.0], [1.0, 2.0], [5.0] * 40, [1e300, -1e300, 0.5], None])
def test_median_by_selection(spark, values):
    if values is None:  # nearly all distinct, a few very far out
        rng = random.Random(2)
        values = [rng.gauss(0, 1) for _ in range(3000)] + [1e12, -1e15]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    ordered, n = sorted(values), len(values)
    want = None if not n else (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
    for ranges, left in ((1024, 100_000), (4, 1), (16, 10)):
        assert op.median_by_selection(frame, "x", ranges, left) == want


def test_top_of_every_day(spark):
    daily = spark.createDataFrame([(f"2024-01-{d:02d}", f"S{s}", (d * s) % 5) for d in range(1, 6) for s in range(9)], "date string, station_id string, difference int")
    got = defaultdict(list)
    for r in op.top_per_day(daily, 3).orderBy("date", "rank").collect():
        got[r["date"]].append((r["difference"], r["station_id"]))
    for d in range(1, 6):
        assert got[f"2024-01-{d:02d}"] == sorted([((d * s) % 5, f"S{s}") for s in range(9)], key=lambda x: (-x[0], x[1]))[:3]
    assert "WindowGroupLimit" in op.top_per_day(daily, 3)._jdf.queryExecution().executedPlan().toString()
