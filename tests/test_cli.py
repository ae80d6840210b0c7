"""The command line: init-only, load CSV files, status."""

import os

from ebbflow.__main__ import main
from ebbflow.sources import FlowTables, write_trips_csv
from tests.helpers import rows, trip, trips_df


def test_cli_init_load_status(spark, tmp_dir, capsys):
    tables = os.path.join(tmp_dir, "tables")
    assert main(["--tables", tables, "--init-only", "--timezone", "UTC"]) == 0
    assert rows(FlowTables(spark, tables).status()) == [("events_hourly", 0), ("station", 0)]
    csv = os.path.join(tmp_dir, "csv")
    write_trips_csv(trips_df(spark, [trip("r1", "2024-01-01 10:00:00", "2024-01-01 11:20:00", "S1", "S2", "One", "Two")]), csv)
    assert main(["--tables", tables, "--input", csv, "--timezone", "UTC"]) == 0
    assert main(["--tables", tables, "--status", "--timezone", "UTC"]) == 0
    out = capsys.readouterr().out
    assert "events_hourly" in out and "station" in out
    assert rows(FlowTables(spark, tables).status()) == [("events_hourly", 2), ("station", 2)]
    assert main(["--tables", tables, "--skip-etl", "--timezone", "UTC"]) == 0
    assert main(["--tables", tables, "--force-init", "--init-only", "--timezone", "UTC"]) == 0
    assert rows(FlowTables(spark, tables).status()) == [("events_hourly", 0), ("station", 0)]
    assert main(["--tables", tables, "--input", os.path.join(tmp_dir, "none*"), "--timezone", "UTC"]) == 2
    assert main(["--tables", tables, "--force-init", "--input", csv, "--timezone", "UTC"]) == 0
    assert rows(FlowTables(spark, tables).status()) == [("events_hourly", 2), ("station", 2)]
