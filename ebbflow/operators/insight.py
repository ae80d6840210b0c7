"""Inventory insight on top of balances: thresholds, alerts, rankings, statistics, histogram, labels
(FLT12-13, AG14-16, SO2-SO7, SC10-SC11).

Rankings use ``orderBy(...).limit(k)``, which Spark plans as a distributed top-k (each task keeps k rows, one
task merges them). Every ordering ends with ``station_id`` so ties resolve the same way on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.config import HIGH_THRESHOLD, HISTOGRAM_BINS, INITIAL_BALANCE, LOW_THRESHOLD, TOP_K
from ebbflow.functions import alert_message, rounded, status_label


def _below_above(balance: str, low: int, high: int, inclusive: bool):
    b = F.col(balance)
    if inclusive:
        return b <= low, b >= high
    return b < low, b > high


def critical_stations(
    balances: DataFrame,
    balance: str = "final_balance",
    low: int = LOW_THRESHOLD,
    high: int = HIGH_THRESHOLD,
    inclusive: bool = True,
    limit: int | None = None,
    order: str = "net_change",
) -> DataFrame:
    """kind ('low' / 'high'), station_id, <balance>: stations at or beyond the thresholds.

    With ``limit`` each kind keeps its first ``limit`` rows in descending ``order`` (the report lists 15).
    """
    is_low, is_high = _below_above(balance, low, high, inclusive)
    parts = []
    for kind, cond in (("low", is_low), ("high", is_high)):
        part = balances.where(cond)
        if limit is not None:
            part = part.orderBy(F.col(order).desc(), F.col("station_id")).limit(limit)
        parts.append(part.select(F.lit(kind).alias("kind"), "station_id", balance))
    return parts[0].unionByName(parts[1])


def balance_alerts(
    balances: DataFrame, low: int = LOW_THRESHOLD, high: int = HIGH_THRESHOLD, inclusive: bool = False
) -> DataFrame:
    """kind, station_id, message for every station outside the limits (strict by default, like the monitor)."""
    is_low, is_high = _below_above("balance", low, high, inclusive)
    kind = F.when(is_low, "low").when(is_high, "high")
    return (
        balances.where(is_low | is_high)
        .select(kind.alias("kind"), "station_id", alert_message("station_name", "balance").alias("message"))
    )


def rebalancing_summary(
    balances: DataFrame, low: int = LOW_THRESHOLD, high: int = HIGH_THRESHOLD, inclusive: bool = True
) -> DataFrame:
    """One row: low_count, high_count, deficit (bikes to add), surplus (bikes to remove), net.

    Measured as the net change of the critical stations; empty groups count as 0.
    """
    is_low, is_high = _below_above("final_balance", low, high, inclusive)
    low_sum = F.coalesce(F.sum(F.when(is_low, F.col("net_change"))), F.lit(0)).cast("bigint")
    high_sum = F.coalesce(F.sum(F.when(is_high, F.col("net_change"))), F.lit(0)).cast("bigint")
    return balances.agg(
        F.count_if(is_low).alias("low_count"),
        F.count_if(is_high).alias("high_count"),
        F.abs(low_sum).alias("deficit"),
        high_sum.alias("surplus"),
        (high_sum + low_sum).alias("net"),
    )


def balance_stats(balances: DataFrame, balance: str = "final_balance") -> DataFrame:
    """One row: mean, median (exact, interpolated), std (sample), min, max; floats rounded to 6 digits.

    The exact median keeps one counter per distinct balance value, a small set for stock levels.
    """
    b = F.col(balance)
    return balances.agg(
        rounded(F.avg(b)).alias("mean"),
        rounded(F.median(b)).alias("median"),
        rounded(F.stddev_samp(b)).alias("std"),
        F.min(b).cast("bigint").alias("min"),
        F.max(b).cast("bigint").alias("max"),
    )


def median_by_selection(df: DataFrame, column: str, ranges: int = 1024, rows: int = 100_000) -> float | None:
    """The exact (interpolated) median of a column, without a task that holds its values: counts per coarse range, then only the range that holds the
    middle, until at most ``rows`` values or one value is left. The driver sees ``ranges`` counts a pass and those last values. NULL and NaN do not count;
    None without values."""
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    n, low, high = values.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if not n:
        return None
    ranks, below, inside = ((n - 1) // 2, n // 2), 0, n
    while inside > rows and low < high:
        middle = values.where(F.col("x").between(low, high))
        at = F.least(F.lit(ranges - 1), F.floor((F.col("x") / 2 - low / 2) / (high / 2 - low / 2) * ranges)).cast("int")  # halves: no overflow
        found = middle.groupBy(at.alias("range")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("range").collect()
        ends, total = [], below
        for r in found:
            total += r["n"]
            ends.append(total)
        one, two = (next(k for k, end in enumerate(ends) if rank < end) for rank in ranks)
        if one != two:  # the two middle values are neighbours across two ranges
            return (found[one]["high"] + found[two]["low"]) / 2
        below, inside, low, high = ends[one] - found[one]["n"], found[one]["n"], found[one]["low"], found[one]["high"]
    if low == high:
        return low
    left = sorted(r["x"] for r in values.where(F.col("x").between(low, high)).collect())  # at most ``rows``
    return (left[ranks[0] - below] + left[ranks[1] - below]) / 2


def balance_stats_by_selection(balances: DataFrame, balance: str = "final_balance", **selection: int) -> DataFrame:
    """``balance_stats`` with the median by distributed selection, for values of any kind and number."""
    b = F.col(balance)
    median = median_by_selection(balances, balance, **selection)
    return balances.agg(
        rounded(F.avg(b)).alias("mean"),
        rounded(F.lit(median).cast("double")).alias("median"),
        rounded(F.stddev_samp(b)).alias("std"),
        F.min(b).cast("bigint").alias("min"),
        F.max(b).cast("bigint").alias("max"),
    )


def balance_histogram(balances: DataFrame, balance: str = "final_balance", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """bin, bin_lo, bin_hi, stations: equal-width bins over [min, max], the last bin closed.

    Same edges as the usual plotting histogram: with min = max the range is widened by 0.5 on each side, so
    all values land in the middle bin. Every bin is listed, empty ones with 0; no input rows, no bins.

    Plan: one global (min, max, count) aggregate feeds both the bin list (exploded from that single row) and,
    as a scalar subquery, the per-row bin index, so no cross join is needed. All consumers read the same
    ``balances`` subtree, which Spark computes once and reuses.
    """
    b = F.col(balance)
    stats = balances.agg(F.min(b).alias("lo"), F.max(b).alias("hi"), F.count(b).alias("n"))
    lo = balances.agg(F.min(b)).scalar()
    hi = balances.agg(F.max(b)).scalar()

    def edges(lo_c, hi_c):
        flat = hi_c == lo_c
        edge0 = F.when(flat, lo_c - F.lit(0.5)).otherwise(lo_c.cast("double"))
        span = F.when(flat, F.lit(1.0)).otherwise((hi_c - lo_c).cast("double"))
        return edge0, span

    # integer-exact bin of a value: floor((b - min) * bins / (max - min)), the top edge folded into the last bin
    exact = F.when(hi == lo, F.lit(bins // 2)).otherwise(
        F.least(F.lit(bins - 1), F.floor((b - lo) * F.lit(bins) / (hi - lo)))
    )
    counts = balances.where(b.isNotNull()).groupBy(exact.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("stations")
    )
    edge0, span = edges(F.col("lo"), F.col("hi"))
    all_bins = stats.where(F.col("n") > 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        edge0.alias("_edge0"),
        span.alias("_span"),
    )
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        F.round(F.col("_edge0") + F.col("bin") * F.col("_span") / F.lit(bins), 6).alias("bin_lo"),
        F.round(F.col("_edge0") + (F.col("bin") + 1) * F.col("_span") / F.lit(bins), 6).alias("bin_hi"),
        F.coalesce(F.col("stations"), F.lit(0)).cast("bigint").alias("stations"),
    )


def surplus_deficit_top(balances: DataFrame, k: int = TOP_K) -> DataFrame:
    """station_id, station_name, net_change: the k largest and the k smallest net changes (duplicates when
    fewer than 2k stations exist)."""
    cols = ["station_id", "station_name", "net_change"]
    top = balances.orderBy(F.col("net_change").desc(), F.col("station_id")).limit(k).select(*cols)
    bottom = balances.orderBy(F.col("net_change"), F.col("station_id").desc()).limit(k).select(*cols)
    return top.unionAll(bottom)


def below_initial_top(balances: DataFrame, initial: int = INITIAL_BALANCE, k: int = TOP_K) -> DataFrame:
    """The k stations furthest below the initial stock (station_id, station_name, balance)."""
    return (
        balances.where(F.col("balance") < initial)
        .orderBy(F.col("balance"), F.col("station_id"))
        .limit(k)
        .select("station_id", "station_name", "balance")
    )


def above_initial_top(balances: DataFrame, initial: int = INITIAL_BALANCE, k: int = TOP_K) -> DataFrame:
    """The k stations furthest above the initial stock (station_id, station_name, balance)."""
    return (
        balances.where(F.col("balance") > initial)
        .orderBy(F.col("balance").desc(), F.col("station_id"))
        .limit(k)
        .select("station_id", "station_name", "balance")
    )


def balance_labels(balances: DataFrame, initial: int = INITIAL_BALANCE) -> DataFrame:
    """station_id, balance, status ('below' / 'above' / 'equal' the initial stock)."""
    return balances.select("station_id", "balance", status_label("balance", initial).alias("status"))


def worst_station(balances: DataFrame) -> DataFrame:
    """The station with the lowest net change (ties: smallest id), one row (SO6)."""
    return balances.orderBy(F.col("net_change"), F.col("station_id")).limit(1).select("station_id")


def day_top(daily: DataFrame, day: str, k: int, largest: bool = True) -> DataFrame:
    """date, station_id, difference: the k largest (or smallest) daily differences on one day (SO5)."""
    order = F.col("difference").desc() if largest else F.col("difference")
    return (
        daily.where(F.col("date") == F.to_date(F.lit(day)))
        .orderBy(order, F.col("station_id"))
        .limit(k)
    )


def top_per_day(daily: DataFrame, k: int, largest: bool = True) -> DataFrame:
    """date, station_id, difference, rank: the k largest (or smallest) daily differences of every day, with a limit inside each task before the shuffle (SO5, all
    days at once)."""
    order = F.col("difference").desc() if largest else F.col("difference")
    by_day = Window.partitionBy("date").orderBy(order, F.col("station_id"))
    return daily.withColumn("rank", F.row_number().over(by_day)).where(F.col("rank") <= k)


def run_summary(
    trips: DataFrame, catalog: DataFrame, deltas: DataFrame, balances: DataFrame, low: int = LOW_THRESHOLD
) -> DataFrame:
    """One row: trips, stations, hourly_events, analysed, low_count, mean_balance (SNK8, AG13).

    The counts of the other frames enter as scalar subqueries of the balance aggregate: each is a separate
    distributed count, and no cross join is planned.
    """
    one = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return balances.agg(
        F.count(F.lit(1)).alias("analysed"),
        F.count_if(F.col("final_balance") <= low).alias("low_count"),
        F.round(F.avg("final_balance"), 6).alias("mean_balance"),
    ).select(
        one(trips).alias("trips"),
        one(catalog).alias("stations"),
        one(deltas).alias("hourly_events"),
        "analysed",
        "low_count",
        "mean_balance",
    )


def flow_run_summary(
    flow: DataFrame,
    member: Column | None = None,
    initial: int = INITIAL_BALANCE,
    low: int = LOW_THRESHOLD,
) -> DataFrame:
    """The run summary (trips, stations, hourly_events, analysed, low_count, mean_balance) from one
    ``flow_with_counts`` aggregate, as one chain: per station, then one global row. No subquery and no join,
    so the trips are scanned once."""
    per = flow.groupBy("station_id").agg(
        F.sum("delta_total").alias("net"),
        F.sum("named_legs").alias("named"),
        F.sum("trips").alias("trips"),
        F.count(F.lit(1)).alias("rows"),
    )
    named = F.col("named") > 0
    analysed = named & member if member is not None else named
    balance = F.lit(initial) + F.col("net")
    return per.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).cast("bigint").alias("trips"),
        F.count_if(named).alias("stations"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("hourly_events"),
        F.count_if(analysed).alias("analysed"),
        F.count_if(analysed & (balance <= low)).alias("low_count"),
        F.round(F.avg(F.when(analysed, balance)), 6).alias("mean_balance"),
    )
