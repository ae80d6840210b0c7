"""The batch job: read trips → clean → catalogue + hourly flow → upsert both tables → summary (SNK7, CF2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow import operators as op
from ebbflow.config import INITIAL_BALANCE, LOW_THRESHOLD
from ebbflow.sources.tables import FlowTables
from ebbflow.sources.trips import read_trips_csv, read_trips_csv_quarantine


def create_tables(spark: SparkSession, root: str, force: bool = False) -> FlowTables:
    """Create the station and flow tables if absent (init-only mode); ``force`` empties existing ones first."""
    tables = FlowTables(spark, root)
    if force:
        tables.drop()
    return tables.create()


def run_batch(
    spark: SparkSession,
    trips: DataFrame | str,
    root: str,
    now: Column | None = None,
    initial: int = INITIAL_BALANCE,
    quarantine: str | None = None,
) -> DataFrame:
    """Load trips (a DataFrame, or a CSV folder / glob) into the tables below ``root``.

    The input is scanned once: it is reduced to flow per (hour, station, name), which is written to the tables' folder;
    catalogue, flow and counts all derive from that table, whose rows are bounded by keys, not trips. Upserts replace
    existing keys (idempotent over re-runs of the same files).

    Returns one row. Of this load: trips, stations and hourly_events (rows upserted). Of the tables after it: analysed
    (active stations), low_count, mean_balance. With ``quarantine`` (a folder) the records of CSV files that the declared schema cannot read are written
    there, and their number is a further column, quarantined.
    """
    rejected = None
    if isinstance(trips, str) and quarantine:
        trips, unread = read_trips_csv_quarantine(spark, trips)
        unread.write.mode("overwrite").parquet(quarantine)
        rejected = spark.read.schema(unread.schema).parquet(quarantine).count()
    elif isinstance(trips, str):
        trips = read_trips_csv(spark, trips)
    tables = create_tables(spark, root)
    flow = tables.stage(op.class_flow_by_name(op.clean_trips(trips)), "flow")
    named = flow.where(F.col("station_name").isNotNull())
    new_stations = named.groupBy("station_id").agg(F.min("station_name").alias("name")).select(F.col("station_id").alias("id"), "name")
    values = [F.sum(c).cast("bigint").alias(c) for c in ("delta_total", "delta_ebike", "delta_other")]
    hourly = tables.stage(flow.groupBy("hour", "station_id").agg(*values), "hourly")
    stations = tables.upsert_stations(new_stations, now)
    deltas = tables.upsert_deltas(hourly, stored=True)

    balances = op.overall_balance(stations, deltas, initial)
    counts = flow.agg(F.coalesce(F.sum("trips"), F.lit(0)).cast("bigint").alias("trips"))
    loaded = new_stations.agg(F.count(F.lit(1)).alias("stations"))
    events = hourly.agg(F.count(F.lit(1)).alias("hourly_events"))
    table = balances.agg(
        F.count(F.lit(1)).alias("analysed"),
        F.count_if(F.col("final_balance") <= LOW_THRESHOLD).alias("low_count"),
        F.round(F.avg("final_balance"), 6).alias("mean_balance"),
    )
    row = table.select(
        counts.scalar().alias("trips"), loaded.scalar().alias("stations"), events.scalar().alias("hourly_events"), "analysed", "low_count", "mean_balance"
    )
    if rejected is not None:
        row = row.withColumn("quarantined", F.lit(rejected).cast("bigint"))
    result = spark.createDataFrame(row.collect(), row.schema)  # one row, before the staged tables go
    tables.drop_staged()
    return result
