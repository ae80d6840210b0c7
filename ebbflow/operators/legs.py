"""Flow legs and station catalogues (PRJ1-2, SE1-2, SE4, FLT6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.config import ARRIVAL_DELTA, DEPARTURE_DELTA


def flow_legs(
    trips: DataFrame,
    start_delta: int = DEPARTURE_DELTA,
    end_delta: int = ARRIVAL_DELTA,
    with_names: bool = False,
    with_class: bool = False,
    mark_trips: bool = False,
) -> DataFrame:
    """Two legs per trip in a single scan: (ts, station_id[, station_name], delta[, trip_leg][, rideable_type]).

    The departure leg carries ``start_delta`` at the start station and time, the arrival leg ``end_delta`` at the
    end station and time. Legs without a station are dropped. ``explode`` over a two-element array replaces the
    union of two projections, which would scan the input twice. With ``mark_trips`` exactly one kept leg of
    each trip has ``trip_leg = 1`` (the departure, or the arrival when the start station is missing), so trips
    can still be counted after the legs are aggregated.
    """

    def leg(role: str, time_col: str, delta: int):
        fields = [F.col(time_col).alias("ts"), F.col(f"{role}_station_id").alias("station_id")]
        if with_names:
            fields.append(F.col(f"{role}_station_name").alias("station_name"))
        fields.append(F.lit(delta).alias("delta"))
        if mark_trips:
            first = F.lit(1) if role == "start" else F.when(F.col("start_station_id").isNull(), 1).otherwise(0)
            fields.append(first.alias("trip_leg"))
        return F.struct(*fields)

    carried = ["rideable_type"] if with_class else []
    legs = trips.select(
        F.explode(F.array(leg("start", "started_at", start_delta), leg("end", "ended_at", end_delta))).alias("leg"),
        *carried,
    )
    return legs.select("leg.*", *carried).where(F.col("station_id").isNotNull())


def station_catalog(trips: DataFrame) -> DataFrame:
    """One row per station id with a name (station_id, station_name).

    Ids seen only without a name are left out. When an id has several names the smallest is kept, so the
    result is deterministic.

    Plan: the legs are first reduced to distinct (id, name) pairs by a hash aggregate (map-side combined, so a
    hot station sends one row per task and name); the string ``min`` (which Spark can only sort-aggregate)
    then runs on those few pairs instead of sorting every leg.
    """
    legs = flow_legs(trips, with_names=True)
    pairs = (
        legs.where(F.col("station_name").isNotNull())
        .groupBy("station_id", "station_name")
        .agg(F.count(F.lit(1)).alias("_legs"))
    )
    # The leg count is duplicate-sensitive: filtering on it keeps the optimizer from folding the pair step away
    # (a bare distinct under a min would be removed as redundant, bringing back the sort over all legs).
    per = pairs.groupBy("station_id").agg(F.min("station_name").alias("station_name"), F.sum("_legs").alias("_legs"))
    return per.where(F.col("_legs") > 0).drop("_legs")


def station_name_pairs(trips: DataFrame) -> DataFrame:
    """Distinct (station_id, station_name) pairs after trimming, both present (SE2 + SE4 on two columns)."""
    legs = flow_legs(trips, with_names=True)
    return (
        legs.select(F.trim("station_id").alias("station_id"), F.trim("station_name").alias("station_name"))
        .where(F.col("station_id").isNotNull() & F.col("station_name").isNotNull())
        .distinct()
    )
