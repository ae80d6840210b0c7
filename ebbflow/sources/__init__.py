"""Inputs and stored tables: trip files, test-table adapters, the Parquet table store."""

from ebbflow.sources.adapters import (
    active_flag,
    nation_catalog,
    nation_station,
    adjustments_from_events,
    events_as_trips,
    read_table,
    shipments_as_trips,
    station_table,
)
from ebbflow.sources.tables import FlowTables
from ebbflow.sources.trips import (
    file_inventory,
    read_trips_csv,
    read_trips_csv_inferred,
    read_trips_csv_quarantine,
    shape_of,
    write_trips_csv,
)

__all__ = [
    "active_flag",
    "nation_catalog",
    "nation_station",
    "FlowTables",
    "adjustments_from_events",
    "events_as_trips",
    "file_inventory",
    "read_table",
    "read_trips_csv",
    "read_trips_csv_inferred",
    "read_trips_csv_quarantine",
    "shape_of",
    "shipments_as_trips",
    "station_table",
    "write_trips_csv",
]
