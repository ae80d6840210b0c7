"""Adapters from the shared test tables to trips, stations and adjustments.

Adapter A (``events`` → trips) is a row-wise projection: no shuffle, so it works on a stream as well. It plants the
dirty cases the cleaning rules exist for (blank and padded ids, blank class, missing end, end before start,
missing names, several names per id). Adapter B (shipments) joins ``lineitem``, ``orders``, ``customer`` and
``supplier``: goods leave the supplier's nation on the order date and arrive in the customer's nation on the ship
date.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.schemas import TRIP_SCHEMA


# Declared layouts of the shared test tables (only the columns the adapters read). A declared schema skips the
# footer-inference job of ``spark.read.parquet`` and fixes the read schema at the columns used.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _station_text(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


# --- fixed values: the adapter-A mapping from an event to a trip (SQL expressions over events columns) ---
_EVENT_KEYS = (
    "*",
    "try_cast(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS _k",
    "CAST(round(value * 100) AS BIGINT) % 100 AS _c2",
)
_EVENT_TRIP = (
    "concat('R', CAST(event_id AS STRING)) AS ride_id",
    "CASE WHEN event_type IN ('click', 'view') THEN 'electric_bike' WHEN event_type = 'purchase' THEN 'classic_bike'"
    " WHEN event_type = 'signup' THEN 'docked_bike' ELSE '  ' END AS rideable_type",
    "ts AS started_at",
    "CASE WHEN event_id % 50 = 7 THEN NULL"
    " ELSE ts + make_dt_interval(0, 0, CAST(event_id % 97 - 3 AS INT), 0) END AS ended_at",
    "CASE WHEN _k % 17 = 5 THEN NULL WHEN event_id % 11 = 0 THEN concat('Station ', _k, ' (temp)')"
    " ELSE concat('Station ', _k) END AS start_station_name",
    "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '' ELSE concat(' S', _k, ' ') END AS start_station_id",
    "CASE WHEN _c2 % 17 = 5 THEN NULL WHEN event_id % 13 = 0 THEN concat('Station ', _c2, ' (temp)')"
    " ELSE concat('Station ', _c2) END AS end_station_name",
    "CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN '   ' ELSE concat('S', _c2) END AS end_station_id",
    "CAST(NULL AS DOUBLE) AS start_lat",
    "CAST(NULL AS DOUBLE) AS start_lng",
    "CAST(NULL AS DOUBLE) AS end_lat",
    "CAST(NULL AS DOUBLE) AS end_lng",
    "CAST(NULL AS STRING) AS member_casual",
)
# --- end of fixed values ---


def events_as_trips(events: DataFrame) -> DataFrame:
    """Adapter A: one trip per event, all 13 trip columns in declared order (coordinates and member class
    NULL). Two projections, no shuffle."""
    trips = events.selectExpr(*_EVENT_KEYS).selectExpr(*_EVENT_TRIP)
    return trips.select(*TRIP_SCHEMA.fieldNames())


def adjustments_from_events(events: DataFrame) -> DataFrame:
    """Manual corrections for adapter A: each signup event moves ``event_id % 7 - 3`` bikes (zeros included)."""
    return events.where(F.col("event_type") == "signup").select(
        _station_text("S", F.col("event_id") % 100).alias("station_id"),
        (F.col("event_id") % 7 - 3).cast("bigint").alias("amount"),
    )


def active_flag(station_id: str = "station_id") -> Column:
    """Fixture rule for adapter A: 0 for stations whose number ends in 9, else 1."""
    number = F.expr(f"try_cast(substr({station_id}, 2) AS INT)")
    return F.when(number % 10 == 9, 0).otherwise(1).cast("int")


def station_table(catalog: DataFrame, created_at: Column | None = None, capacity: Column | None = None) -> DataFrame:
    """Station rows (id, name, capacity, is_active, created_at_utc) for a catalogue (station_id, station_name).

    Fixture rule for adapter A: stations whose number ends in 9 are inactive.
    """
    return catalog.select(
        F.col("station_id").alias("id"),
        F.col("station_name").alias("name"),
        (capacity if capacity is not None else F.lit(None)).cast("int").alias("capacity"),
        active_flag("station_id").alias("is_active"),
        (created_at if created_at is not None else F.lit(None)).cast("timestamp").alias("created_at_utc"),
    )


def shipments_as_trips(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Adapter B: one trip per line item, from the supplier's nation (order date) to the customer's (ship date).

    Stations are the integer nation keys: no text is built, trimmed or hashed per shipment; ``nation_station`` turns the
    few aggregated keys into station ids. Each dimension is joined to its own fact before the large
    ``lineitem ⋈ orders`` join, so that join shuffles only narrow rows. Join strategies are left to AQE, which broadcasts
    a side only once its measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and splits skewed
    keys (a hot supplier or order) otherwise.
    """
    cust = customer.select("c_custkey", "c_nationkey")
    supp = supplier.select("s_suppkey", "s_nationkey")
    orders_n = orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        cust, F.col("o_custkey") == F.col("c_custkey")
    )
    lines_n = lineitem.select("l_orderkey", "l_suppkey", "l_shipdate").join(
        supp, F.col("l_suppkey") == F.col("s_suppkey")
    )
    joined = lines_n.join(orders_n, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("o_orderdate").alias("started_at"),
        F.col("l_shipdate").alias("ended_at"),
        F.col("s_nationkey").alias("start_station_id"),
        F.col("c_nationkey").alias("end_station_id"),
    )


def nation_station(key: str) -> Column:
    """Station id of a nation key."""
    return _station_text("N", F.col(key))


def nation_catalog(nation: DataFrame) -> DataFrame:
    """station_id, station_name of the nations (the place catalogue of adapter B)."""
    return nation.select(_station_text("N", F.col("n_nationkey")).alias("station_id"), F.col("n_name").alias("station_name"))
