"""Bucketed signed flow per station (AG1-AG5, JN6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.config import ARRIVAL_DELTA, DEPARTURE_DELTA, EBIKE_CLASS
from ebbflow.functions import day_of, hour_text
from ebbflow.operators.legs import flow_legs


def _bucket(grain: str) -> Column:
    if grain == "hour":
        return hour_text("ts").alias("hour")
    if grain == "day":
        return day_of("ts").alias("date")
    raise ValueError(f"unknown grain {grain!r}")


def bucketed_deltas(legs: DataFrame, grain: str = "hour", by_class: bool = False, counts: bool = False) -> DataFrame:
    """Sum of leg deltas per (bucket, station_id) → delta_total [, delta_ebike, delta_other][, named_legs, trips].

    With ``counts`` (legs from ``flow_legs(with_names=True, mark_trips=True)``) two numbers ride along:
    ``named_legs`` (legs that carry a station name) and ``trips`` (trips whose marked leg falls here). They let
    catalogue membership and trip totals be derived from this one aggregate.

    A hash aggregate with map-side combine: each task ships at most one row per (bucket, station) it has seen,
    so the shuffle is bounded by the number of keys, not trips, and a hot station cannot skew it.
    """
    aggs = [F.sum("delta").cast("bigint").alias("delta_total")]
    if by_class:
        ebike = F.coalesce(F.col("rideable_type") == EBIKE_CLASS, F.lit(False))
        aggs += [
            F.sum(F.when(ebike, F.col("delta")).otherwise(0)).cast("bigint").alias("delta_ebike"),
            F.sum(F.when(ebike, 0).otherwise(F.col("delta"))).cast("bigint").alias("delta_other"),
        ]
    if counts:
        aggs += [
            F.count("station_name").alias("named_legs"),
            F.sum("trip_leg").cast("bigint").alias("trips"),
        ]
    return legs.groupBy(_bucket(grain), "station_id").agg(*aggs)


def flow_with_counts(trips: DataFrame) -> DataFrame:
    """hour, station_id, delta_total, named_legs, trips from one scan of cleaned trips (see bucketed_deltas)."""
    return bucketed_deltas(flow_legs(trips, with_names=True, mark_trips=True), "hour", counts=True)


def class_flow_by_name(trips: DataFrame) -> DataFrame:
    """hour, station_id, station_name, delta_total, delta_ebike, delta_other, trips from one scan of cleaned trips.

    The one aggregate of a load: the station catalogue, the hourly flow and the number of trips all derive from it.
    """
    legs = flow_legs(trips, with_names=True, with_class=True, mark_trips=True)
    ebike = F.coalesce(F.col("rideable_type") == EBIKE_CLASS, F.lit(False))
    return legs.groupBy(hour_text("ts").alias("hour"), "station_id", "station_name").agg(
        F.sum("delta").cast("bigint").alias("delta_total"),
        F.sum(F.when(ebike, F.col("delta")).otherwise(0)).cast("bigint").alias("delta_ebike"),
        F.sum(F.when(ebike, 0).otherwise(F.col("delta"))).cast("bigint").alias("delta_other"),
        F.sum("trip_leg").cast("bigint").alias("trips"),
    )


def hourly_deltas(trips: DataFrame, by_class: bool = False) -> DataFrame:
    """hour, station_id, delta_total [, delta_ebike, delta_other]: −1 per departure, +1 per arrival."""
    return bucketed_deltas(flow_legs(trips, with_class=by_class), "hour", by_class)


def arrivals_departures(trips: DataFrame) -> DataFrame:
    """station_id, hour, arrivals, departures, delta in one aggregation.

    Equal to the full outer join of separately grouped arrivals and departures with missing counts as 0, without
    the second aggregation and the join.
    """
    legs = flow_legs(trips)
    return (
        legs.groupBy("station_id", hour_text("ts").alias("hour"))
        .agg(
            F.count_if(F.col("delta") > 0).alias("arrivals"),
            F.count_if(F.col("delta") < 0).alias("departures"),
        )
        .withColumn("delta", F.col("arrivals") - F.col("departures"))
    )


def net_flow_by_station(
    trips: DataFrame, start_delta: int = -DEPARTURE_DELTA, end_delta: int = -ARRIVAL_DELTA
) -> DataFrame:
    """station_id, difference over all time. The exploratory sign (+1 start, −1 end) is the default."""
    legs = flow_legs(trips, start_delta, end_delta)
    return legs.groupBy("station_id").agg(F.sum("delta").cast("bigint").alias("difference"))


def daily_net_flow(
    trips: DataFrame, start_delta: int = -DEPARTURE_DELTA, end_delta: int = -ARRIVAL_DELTA
) -> DataFrame:
    """date, station_id, difference per calendar day (legs without a date or station are dropped)."""
    legs = flow_legs(trips, start_delta, end_delta).where(F.col("ts").isNotNull())
    return legs.groupBy(day_of("ts").alias("date"), "station_id").agg(
        F.sum("delta").cast("bigint").alias("difference")
    )
