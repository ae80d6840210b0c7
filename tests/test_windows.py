"""Event-time windows and the carried balances of the stream, with late rows."""

import datetime as dt
import os

from ebbflow.streaming import FlowStreamSink, WindowSink
from tests.helpers import rows

TRIP = "ride_id string, rideable_type string, started_at timestamp, ended_at timestamp, start_station_name string, start_station_id string, end_station_name string, end_station_id string"


def leaving(spark, *when):
    """Trips that leave station A at the given times and arrive nowhere known."""
    at = [dt.datetime.fromisoformat(w) for w in when]
    return spark.createDataFrame([(f"R{i}", "x", t, t, "Name A", "A", None, None) for i, t in enumerate(at)], TRIP)


def test_late_rows_are_kept_apart_and_added(spark, tmp_dir):
    sink = WindowSink(spark, os.path.join(tmp_dir, "w"), "1 hour")
    assert sink.watermark() is None and sink.deltas().count() == sink.late().count() == sink.closed().count() == 0
    sink.write_batch(leaving(spark, "2024-01-01 08:10:00", "2024-01-01 10:30:00"), 0)  # nothing is late in the first batch
    assert sink.watermark() == "2024-01-01 09:30:00"
    assert rows(sink.closed(), "hour", "delta_total") == [("2024-01-01 08:00:00", -1)]
    second = leaving(spark, "2024-01-01 08:20:00", "2024-01-01 09:20:00", "2024-01-01 12:00:00")
    for _ in range(2):  # a replay changes nothing
        sink.write_batch(second, 1)
        assert rows(sink.late(), "hour", "delta_total") == [("2024-01-01 08:00:00", -1)]
        assert sorted(rows(sink.closed(), "hour", "delta_total")) == [(f"2024-01-01 {h}:00:00", -1) for h in ("08", "09", "10")]  # 8:00 stays what it was
        assert sorted(rows(sink.open(), "hour", "delta_total")) == [("2024-01-01 12:00:00", -1)]
        assert sorted(rows(sink.deltas(), "hour", "delta_total")) == [("2024-01-01 08:00:00", -2), ("2024-01-01 09:00:00", -1), ("2024-01-01 10:00:00", -1), ("2024-01-01 12:00:00", -1)]
    sink.write_batch(leaving(spark), 2)  # an empty batch
    assert sink.watermark() == "2024-01-01 11:00:00"


def test_open_balances_with_a_late_hour(spark, tmp_dir):
    """A base with hours 8, 10 and 12, then a trip at 9."""
    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "s"))
    sink.write_batch(leaving(spark, "2024-01-01 20:00:00", "2024-01-02 08:00:00", "2024-01-02 10:00:00", "2024-01-02 12:00:00", "2024-01-04 07:00:00"), 0)
    sink.compact()
    assert sink.open_balances().count() == 0
    sink.write_batch(leaving(spark, "2024-01-02 09:00:00"), 1)
    want = {"2024-01-02 09:00:00": -3, "2024-01-02 10:00:00": -4, "2024-01-02 12:00:00": -5}
    assert dict(rows(sink.open_balances(), "hour", "balance")) == want
    sink.write_batch(leaving(spark, "2023-12-31 23:00:00", "2024-01-03 01:00:00", "2024-01-04 09:00:00"), 2)
    got = dict(rows(sink.open_balances(), "hour", "balance"))
    every = {r["hour"]: r["balance"] for r in sink.balances().collect()}
    assert got == {h: b for h, b in every.items() if h[:10] != "2024-01-01"} and len(got) == 8  # the day that no open batch touched is not read
    paths = {f.split("date=")[1][:10] for f in sink.open_balances().inputFiles() if "base/deltas" in f}
    assert paths  # the base's days are partitions; the touched ones are chosen at run time
    plan = sink.open_balances()._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower() or "LeftSemi" in plan
    assert sink.compact() == 2 and dict(rows(sink.balances(), "hour", "balance")) == every


def test_compaction_in_a_session_with_dynamic_overwrite(spark, tmp_dir):
    key = "spark.sql.sources.partitionOverwriteMode"
    usual = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        sink = FlowStreamSink(spark, os.path.join(tmp_dir, "s"))
        sink.write_batch(leaving(spark, "2024-01-01 20:00:00", "2024-01-02 08:00:00"), 0)
        assert sink.compact() == 0 and sink.compact() == 0
        assert dict(rows(sink.deltas(), "hour", "delta_total")) == {"2024-01-01 20:00:00": -1, "2024-01-02 08:00:00": -1}
    finally:
        spark.conf.set(key, usual)
