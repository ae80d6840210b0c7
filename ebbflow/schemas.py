"""Declared schemas of inputs and stored tables (no inference on the hot path)."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: the columns of a trip file, in file order ---
# Trip records as delivered by the operator of the fleet; every column is nullable.
TRIP_SCHEMA = StructType(
    [
        StructField("ride_id", StringType()),
        StructField("rideable_type", StringType()),
        StructField("started_at", TimestampType()),
        StructField("ended_at", TimestampType()),
        StructField("start_station_name", StringType()),
        StructField("start_station_id", StringType()),
        StructField("end_station_name", StringType()),
        StructField("end_station_id", StringType()),
        StructField("start_lat", DoubleType()),
        StructField("start_lng", DoubleType()),
        StructField("end_lat", DoubleType()),
        StructField("end_lng", DoubleType()),
        StructField("member_casual", StringType()),
    ]
)
# --- end of fixed values ---

# Station catalogue table; key: id.
STATION_SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("name", StringType(), False),
        StructField("capacity", IntegerType()),
        StructField("is_active", IntegerType()),
        StructField("created_at_utc", TimestampType()),
    ]
)

# Hourly flow table; key: (hour, station_id); stored partitioned by ``date`` (the day of ``hour``).
DELTA_SCHEMA = StructType(
    [
        StructField("hour", StringType(), False),
        StructField("station_id", StringType(), False),
        StructField("delta_total", LongType(), False),
        StructField("delta_ebike", LongType()),
        StructField("delta_other", LongType()),
    ]
)
