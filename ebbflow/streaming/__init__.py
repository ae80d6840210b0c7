"""Structured Streaming: trip file streams, an idempotent micro-batch sink, stateful operators."""

from ebbflow.streaming.flow import (
    FlowStreamSink,
    distinct_pairs_stream,
    live_station_totals,
    read_events_stream,
    read_trips_stream,
    run_available,
    start_flow_stream,
)
from ebbflow.streaming.windows import WindowSink, start_window_stream

__all__ = [
    "FlowStreamSink",
    "WindowSink",
    "distinct_pairs_stream",
    "live_station_totals",
    "read_events_stream",
    "read_trips_stream",
    "run_available",
    "start_flow_stream",
    "start_window_stream",
]
