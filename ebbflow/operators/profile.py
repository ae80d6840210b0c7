"""Data-quality profiles of the trip input (AG8-AG13, FLT5, PRJ4, JN8).

Each profile is a single aggregation pass; conditional counts use ``count_if`` so several measures share one
scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.functions import rounded


def _pct(part, total):
    return rounded(part * F.lit(100.0) / total)


def bike_type_counts(trips: DataFrame) -> DataFrame:
    """rideable_type, count (a missing class is its own group)."""
    return trips.groupBy("rideable_type").agg(F.count(F.lit(1)).alias("count"))


def trip_sample(trips: DataFrame, n: int = 5) -> DataFrame:
    """The first n trips by ride_id, with their stations."""
    return (
        trips.select(
            "ride_id", "rideable_type", "start_station_id", "start_station_name", "end_station_id", "end_station_name"
        )
        .orderBy("ride_id")
        .limit(n)
    )


def trip_date_range(trips: DataFrame) -> DataFrame:
    """earliest_trip (first start), latest_trip (last end) as ISO text with microseconds."""
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return trips.agg(
        F.date_format(F.min("started_at"), fmt).alias("earliest_trip"),
        F.date_format(F.max("ended_at"), fmt).alias("latest_trip"),
    )


def _distinct_with_null(c: str):
    # a missing station counts as one more distinct value, as in distinct().count()
    return (F.count_distinct(F.col(c)) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))).cast("bigint")


def distinct_station_counts(trips: DataFrame) -> DataFrame:
    """start_stations, end_stations: distinct ids per role, a missing id counted once."""
    return trips.agg(
        _distinct_with_null("start_station_id").alias("start_stations"),
        _distinct_with_null("end_station_id").alias("end_stations"),
    )


def null_station_summary(trips: DataFrame) -> DataFrame:
    """One row: total, null_start, null_end, null_any and their percentages of all trips."""
    s, e = F.col("start_station_id").isNull(), F.col("end_station_id").isNull()
    counts = trips.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s).alias("null_start"),
        F.count_if(e).alias("null_end"),
        F.count_if(s | e).alias("null_any"),
    )
    return counts.select(
        "total",
        "null_start",
        "null_end",
        "null_any",
        _pct(F.col("null_start"), F.col("total")).alias("null_start_pct"),
        _pct(F.col("null_end"), F.col("total")).alias("null_end_pct"),
        _pct(F.col("null_any"), F.col("total")).alias("null_any_pct"),
    )


def null_station_by_type(trips: DataFrame) -> DataFrame:
    """rideable_type, total_trips, null_start, null_end and percentages per class."""
    return (
        trips.groupBy("rideable_type")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.count_if(F.col("start_station_id").isNull()).alias("null_start"),
            F.count_if(F.col("end_station_id").isNull()).alias("null_end"),
        )
        .withColumn("null_start_pct", _pct(F.col("null_start"), F.col("total_trips")))
        .withColumn("null_end_pct", _pct(F.col("null_end"), F.col("total_trips")))
    )


def usable_trip_summary(trips: DataFrame) -> DataFrame:
    """One row: total, usable (both stations), excluded, usable_pct."""
    usable = F.col("start_station_id").isNotNull() & F.col("end_station_id").isNotNull()
    counts = trips.agg(F.count(F.lit(1)).alias("total"), F.count_if(usable).alias("usable"))
    return counts.select(
        "total",
        "usable",
        (F.col("total") - F.col("usable")).alias("excluded"),
        _pct(F.col("usable"), F.col("total")).alias("usable_pct"),
    )


def orphan_station_events(deltas: DataFrame, stations: DataFrame) -> DataFrame:
    """station_id, rows: delta rows whose station is missing from the station table (the unenforced key)."""
    known = stations.select(F.col("id").alias("station_id"))
    return (
        deltas.join(known, "station_id", "left_anti")
        .groupBy("station_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """name, rows for several frames, as one union of global counts (AG13, SNK5)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def station_flow_totals(flow: DataFrame) -> DataFrame:
    """station_id, net_change, named_legs, rows per station from a ``flow_with_counts`` aggregate."""
    return flow.groupBy("station_id").agg(
        F.sum("delta_total").cast("bigint").alias("net_change"),
        F.sum("named_legs").cast("bigint").alias("named_legs"),
        F.count(F.lit(1)).alias("rows"),
    )


def unnamed_stations(flow: DataFrame) -> DataFrame:
    """station_id, rows: stations whose legs never carry a name (they cannot enter the catalogue), with their
    number of flow rows. Same result as ``orphan_station_events`` when the catalogue comes from the same trips,
    from one aggregate instead of an anti join of two."""
    return station_flow_totals(flow).where(F.col("named_legs") == 0).select("station_id", "rows")


def flow_status(flow: DataFrame) -> DataFrame:
    """name, rows for the station catalogue and the hourly flow, both counted from one aggregate chain."""
    counts = station_flow_totals(flow).agg(
        F.count_if(F.col("named_legs") > 0).alias("station"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("events_hourly"),
    )
    return counts.select(F.expr("stack(2, 'station', station, 'events_hourly', events_hourly) AS (name, rows)"))
