"""Command line: create tables, load trip CSV files, print table status (CF2).

    python -m ebbflow --tables DIR --init-only
    python -m ebbflow --tables DIR --input 'landing/*.csv'
    python -m ebbflow --tables DIR --status
    python -m ebbflow --tables DIR --skip-etl          (create if missing, show status)
    python -m ebbflow --tables DIR --force-init --input 'landing/*.csv'
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ebbflow", description="Station-flow tables on Spark")
    p.add_argument("--tables", required=True, help="folder of the station and events_hourly tables (shared storage)")
    p.add_argument("--input", help="trip CSV files: folder or glob")
    p.add_argument("--init-only", action="store_true", help="create empty tables and stop")
    p.add_argument("--status", action="store_true", help="print row counts per table and stop")
    p.add_argument("--skip-etl", action="store_true", help="create missing tables and print their status, no load")
    p.add_argument(
        "--force-init", action="store_true", help="drop the tables and create them empty before anything else"
    )
    p.add_argument("--timezone", default=None, help="session time zone for wall-clock trip times")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from ebbflow.config import TIMEZONE, configure
    from ebbflow.plans.job import create_tables, run_batch
    from ebbflow.sources.tables import FlowTables, hadoop_glob

    spark = configure(SparkSession.builder.appName("ebbflow").getOrCreate(), args.timezone or TIMEZONE)
    if args.status:
        FlowTables(spark, args.tables).status().show(truncate=False)
        return 0
    create_tables(spark, args.tables, force=args.force_init)
    if args.init_only:
        return 0
    if args.skip_etl:
        FlowTables(spark, args.tables).status().show(truncate=False)
        return 0
    if not args.input:
        p.error("--input is required unless --init-only or --status is given")
    found = hadoop_glob(spark, args.input)
    if not found:
        print(f"no input: nothing matches {args.input}", file=sys.stderr)
        return 2
    print(f"{found} input file(s) or folder(s)")
    run_batch(spark, args.input, args.tables).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
