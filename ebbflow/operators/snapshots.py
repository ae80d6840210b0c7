"""Running sums in two levels: per station and day, then over day totals (WN1, WN2, AG7, JN2).

The prefix sum of a station's flow is cut at days. Inside a day a window sees the hours of one station and day (at most 24 at hour
grain); over days it sees one row per station and day. A *day total* is a station's net flow up to the end of a day; a stored table of them answers any hour
with one day of totals and one day of hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.config import INITIAL_BALANCE


def with_day(deltas: DataFrame) -> DataFrame:
    """Flow rows with the day of their hour as ``date`` (kept if the rows have it)."""
    return deltas if "date" in deltas.columns else deltas.withColumn("date", F.to_date(F.substring("hour", 1, 10)))


def day_nets(deltas: DataFrame) -> DataFrame:
    """date, station_id, net: flow per station and day."""
    return with_day(deltas).groupBy("date", "station_id").agg(F.sum("delta_total").cast("bigint").alias("net"))


def day_totals(nets: DataFrame) -> DataFrame:
    """date, station_id, total: the flow of every station up to the end of each day, on all days of ``nets`` from the station's first on.

    The list of days (one row, as long as the calendar) reaches each row as a scalar subquery; a row is repeated on the days up to the station's next one.
    """
    by_day = Window.partitionBy("station_id").orderBy("date")
    days = nets.agg(F.array_sort(F.collect_set("date"))).scalar()
    running = nets.withColumn("_days", days).select(
        "station_id", "date", "_days", F.sum("net").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("total"), F.lead("date").over(by_day).alias("_next")
    )
    held = F.filter("_days", lambda d: (d >= F.col("date")) & (F.col("_next").isNull() | (d < F.col("_next"))))
    return running.select(F.explode(held).alias("date"), "station_id", F.col("total").cast("bigint").alias("total"))


def balance_within_days(deltas: DataFrame, before: DataFrame, initial: int = INITIAL_BALANCE) -> DataFrame:
    """station_id, hour, delta_total, balance: the running balance of flow rows, each day on top of ``before`` (date, station_id, before: the flow up to
    the day; stations without a row there start at ``initial``)."""
    inside = Window.partitionBy("station_id", "date").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    rows = with_day(deltas).join(before, ["date", "station_id"], "left")
    start = F.lit(initial) + F.coalesce("before", F.lit(0))
    return rows.select("station_id", "hour", "delta_total", (start + F.sum("delta_total").over(inside)).cast("bigint").alias("balance"))


def running_balance_by_day(deltas: DataFrame, initial: int = INITIAL_BALANCE) -> DataFrame:
    """station_id, hour, delta_total, balance as ``running_balance``, at any grain: no window partition holds more than a station's rows of one day,
    or its days."""
    d = with_day(deltas.select("hour", "station_id", "delta_total"))
    earlier = Window.partitionBy("station_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    before = day_nets(d).select("date", "station_id", F.sum("net").over(earlier).alias("before"))
    return balance_within_days(d, before, initial)


def totals_at(start: DataFrame, corrections: DataFrame, hours: DataFrame) -> DataFrame:
    """station_id, net_change from a day's totals (station_id, total), later corrections of earlier days (station_id, net) and the hours after (station_id,
    delta_total)."""
    parts = [start.select("station_id", F.col("total").alias("n")), corrections.select("station_id", F.col("net").alias("n")), hours.select("station_id", F.col("delta_total").alias("n"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("station_id").agg(F.sum("n").cast("bigint").alias("net_change"))
