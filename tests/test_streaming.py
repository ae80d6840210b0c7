"""Streaming: multi-file streams equal batch, replays are idempotent, stateful variants."""

import os
import shutil

import pyarrow.parquet as pq
import pytest

from ebbflow import operators as op
from ebbflow.plans import catalog as q
from ebbflow.sources import events_as_trips
from ebbflow.streaming import (
    FlowStreamSink,
    distinct_pairs_stream,
    read_events_stream,
    run_available,
    start_flow_stream,
)
from tests.conftest import SF_SMOKE
from tests.helpers import rows


@pytest.fixture()
def split_events(tmp_dir):
    """The sf0.001 events split by time into 4 files, written one after another."""
    table = pq.read_table(os.path.join(SF_SMOKE, "events.parquet")).sort_by("ts")
    folder = os.path.join(tmp_dir, "landing")
    os.makedirs(folder)
    n = table.num_rows
    for i in range(4):
        pq.write_table(table.slice(i * n // 4, (i + 1) * n // 4 - i * n // 4), os.path.join(folder, f"part-{i}.parquet"))
    return folder


def batch_deltas(spark):
    return rows(q.deltas(spark, SF_SMOKE), "hour", "station_id", "delta_total")


def test_stream_equals_batch_over_split_files(spark, split_events, tmp_dir):
    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "out"))
    trips = events_as_trips(read_events_stream(spark, split_events, 1))
    query = start_flow_stream(trips, sink, os.path.join(tmp_dir, "ckpt"), available_now=True)
    run_available(query)
    batches = spark.read.parquet(sink.deltas_path).select("batch_id").distinct().count()
    assert batches == 4
    assert rows(sink.deltas(), "hour", "station_id", "delta_total") == batch_deltas(spark)
    pairs = rows(sink.pairs())
    assert pairs == rows(op.station_name_pairs(q.norm_trips(spark, SF_SMOKE)))


def test_replayed_batch_is_idempotent(spark, tmp_dir):
    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "out"))
    batch = q.raw_trips(spark, SF_SMOKE)
    sink.write_batch(batch, 0)
    once = rows(sink.deltas())
    sink.write_batch(batch, 0)
    assert rows(sink.deltas()) == once
    assert rows(sink.deltas(), "hour", "station_id", "delta_total") == batch_deltas(spark)


def test_stream_balance_starts_at_zero(spark, tmp_dir):
    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "out"))
    sink.write_batch(q.raw_trips(spark, SF_SMOKE), 7)
    expected = rows(op.running_balance(q.deltas(spark, SF_SMOKE), 0), "station_id", "hour", "balance")
    assert rows(sink.balances(), "station_id", "hour", "balance") == expected


def test_sink_is_readable_before_the_first_batch(spark, tmp_dir):
    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "out"))
    assert sink.deltas().count() == sink.pairs().count() == sink.balances().count() == sink.open_balances().count() == 0
    assert sink.compact() == -1


def test_compaction_keeps_totals_and_carries_balances(spark, tmp_dir):
    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "out"))
    trips = q.raw_trips(spark, SF_SMOKE)
    bounds = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-03-01"]
    parts = [trips.where(f"started_at >= '{a}' AND started_at < '{b}'") for a, b in zip(bounds, bounds[1:])]
    for n in (0, 2):  # the second week comes late, after a compaction
        sink.write_batch(parts[n], n)
    assert sink.compact() == 2 and sink.compact() == 2
    sink.write_batch(parts[1], 3)
    sink.write_batch(parts[3], 4)
    sink.write_batch(parts[3], 4)  # a replay
    assert rows(sink.deltas(), "hour", "station_id", "delta_total") == batch_deltas(spark)
    assert rows(sink.pairs()) == rows(op.station_name_pairs(q.norm_trips(spark, SF_SMOKE)))
    opened = rows(sink.open_balances(20), "station_id", "hour", "balance")
    assert len(opened) > 500 and set(opened) <= set(rows(sink.balances(20), "station_id", "hour", "balance"))  # the second week's too, which came late
    changed = set(rows(sink.open_deltas(), "station_id", "hour"))
    assert changed <= {r[:2] for r in opened}
    assert sink.compact() == 4
    assert sink.open_balances().count() == 0
    assert rows(sink.deltas(), "hour", "station_id", "delta_total") == batch_deltas(spark)


def test_distinct_pairs_stream(spark, split_events, tmp_dir):
    trips = events_as_trips(read_events_stream(spark, split_events, 1))
    out = os.path.join(tmp_dir, "pairs")
    query = (distinct_pairs_stream(trips).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", os.path.join(tmp_dir, "pckpt")).trigger(availableNow=True).start())
    run_available(query)
    got = rows(spark.read.parquet(out))
    assert got == rows(op.station_name_pairs(q.norm_trips(spark, SF_SMOKE)))


def test_compact_into_table_equals_batch(spark, tmp_dir):
    from ebbflow.sources import FlowTables

    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "out"))
    trips = q.raw_trips(spark, SF_SMOKE)
    sink.write_batch(trips.where("started_at < '2024-01-15'"), 0)
    sink.write_batch(trips.where("started_at >= '2024-01-15'"), 1)
    tables = FlowTables(spark, os.path.join(tmp_dir, "tables")).create()
    sink.compact_into(tables)
    sink.compact_into(tables)  # repeatable
    assert rows(tables.deltas(), "hour", "station_id", "delta_total") == batch_deltas(spark)


def test_csv_stream_one_file_per_trigger(spark, tmp_dir):
    from ebbflow.sources import write_trips_csv
    from ebbflow.streaming import read_trips_stream

    trips = q.raw_trips(spark, SF_SMOKE)
    landing = os.path.join(tmp_dir, "landing")
    write_trips_csv(trips.where("started_at < '2024-01-15'").coalesce(1), os.path.join(tmp_dir, "a"))
    write_trips_csv(trips.where("started_at >= '2024-01-15'").coalesce(1), os.path.join(tmp_dir, "b"))
    os.makedirs(landing)
    for part in ("a", "b"):  # land the files one after another
        src = [f for f in os.listdir(os.path.join(tmp_dir, part)) if f.endswith(".csv")][0]
        shutil.copyfile(os.path.join(tmp_dir, part, src), os.path.join(landing, f"{part}.csv"))
    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "out"))
    stream = read_trips_stream(spark, landing, "csv", max_files_per_trigger=1)
    run_available(start_flow_stream(stream, sink, os.path.join(tmp_dir, "ckpt"), available_now=True))
    assert spark.read.parquet(sink.deltas_path).select("batch_id").distinct().count() == 2
    assert rows(sink.deltas(), "hour", "station_id", "delta_total") == batch_deltas(spark)


def test_live_station_totals(spark, split_events, tmp_dir):
    from ebbflow.streaming import live_station_totals

    trips = events_as_trips(read_events_stream(spark, split_events, 1))
    out = {}

    def keep(batch, batch_id):
        for r in batch.collect():  # test sink: at most one row per station per batch
            out[r["station_id"]] = r["net_change"]

    query = (live_station_totals(trips).writeStream.outputMode("update").foreachBatch(keep)
             .option("checkpointLocation", os.path.join(tmp_dir, "lckpt")).trigger(availableNow=True).start())
    run_available(query)
    expected = {r["station_id"]: r["total"] for r in
                q.deltas(spark, SF_SMOKE).groupBy("station_id").agg({"delta_total": "sum"})
                .withColumnRenamed("sum(delta_total)", "total").collect()}
    assert out == expected


def test_late_files_still_count(spark, split_events, tmp_dir):
    """Files landing out of event-time order: the partial-delta sink keeps every trip (no watermark)."""
    files = sorted(os.listdir(split_events))
    # newest event times land first: give the last file the oldest modification time
    for rank, name in enumerate(reversed(files)):
        os.utime(os.path.join(split_events, name), (1_700_000_000 + rank * 60, 1_700_000_000 + rank * 60))
    sink = FlowStreamSink(spark, os.path.join(tmp_dir, "out"))
    trips = events_as_trips(read_events_stream(spark, split_events, 1))
    run_available(start_flow_stream(trips, sink, os.path.join(tmp_dir, "ckpt"), available_now=True))
    assert rows(sink.deltas(), "hour", "station_id", "delta_total") == batch_deltas(spark)
    expected_balance = rows(op.running_balance(q.deltas(spark, SF_SMOKE), 0), "station_id", "hour", "balance")
    assert rows(sink.balances(), "station_id", "hour", "balance") == expected_balance
