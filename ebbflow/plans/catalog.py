"""The named queries: each takes (spark, sf_dir) and returns a lazy DataFrame over the whole input tables.

Adapter A (``events`` → trips) feeds the station queries, adapter B (shipments) the ``shipment_*`` queries.
Fixed parameters of the registered queries (hour bounds, the looked-up station, the report day) are listed
below; the operators take any value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow import operators as op
from ebbflow.config import CRITICAL_LIST_LIMIT, DASHBOARD_START_INDEX, DAILY_TOP_K, INITIAL_BALANCE, scratch_path
from ebbflow.sources import (
    FlowTables,
    active_flag,
    adjustments_from_events,
    events_as_trips,
    file_inventory,
    nation_catalog,
    nation_station,
    read_table,
    read_trips_csv,
    read_trips_csv_inferred,
    read_trips_csv_quarantine,
    shape_of,
    shipments_as_trips,
    station_table,
    write_trips_csv,
)
from ebbflow.plans.job import run_batch
from ebbflow.schemas import TRIP_SCHEMA
from ebbflow.streaming import (
    FlowStreamSink,
    distinct_pairs_stream,
    WindowSink,
    read_events_stream,
    read_trips_stream,
    run_available,
    start_flow_stream,
    start_window_stream,
)

# --- parameters of the registered queries ---
AS_OF_HOUR = "2024-01-15 12:00:00"
LOOKUP_STATION = "S42"
LOOKUP_HOUR = "2024-01-20 00:00:00"
RANGE_START = "2024-01-10 00:00:00"
RANGE_END = "2024-01-20 23:00:00"
REPORT_DAY = "2024-01-05"
CARRY_FROM = "2024-01-15 00:00:00"
DASHBOARD_STEPS = 6
UPSERT_OLD_BEFORE = "2024-01-20 00:00:00"
UPSERT_NEW_FROM = "2024-01-15 00:00:00"
OLD_CREATED = "2024-01-01 00:00:00"
NEW_CREATED = "2024-02-01 00:00:00"
OLD_CAPACITY = 20
STREAM_FILES = 4
WINDOW_DELAY = "1 day"
LATE_EVERY = 5  # every fifth event comes after the totals were summed up
DELETED_SUFFIX = "3"
MALFORMED_EVERY, MALFORMED_AT = 40, 3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared inputs ---
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_trips(events(spark, sf_dir))


def norm_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.normalise_trips(raw_trips(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_trips(raw_trips(spark, sf_dir))


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hourly_deltas(clean(spark, sf_dir))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.station_catalog(clean(spark, sf_dir))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_table(catalog(spark, sf_dir))


def balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall balance of the active stations, catalogue and flow from one aggregation over the legs."""
    b = op.balance_from_trips(clean(spark, sf_dir), member=active_flag() == 1)
    return b.select("station_id", "station_name", "net_change", F.col("balance").alias("final_balance"))


def adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances at the dashboard hour (start 16, +6 steps) with the manual adjustments.

    One aggregate of the trips by (hour, station, name) gives the stepped hour (a scalar subquery), the catalogue and
    the bounded flow; the adjustments are another input, which here happens to be derived from the same file.
    """
    flow = op.flow_by_name(clean(spark, sf_dir))
    hour = op.hour_at_step(flow, DASHBOARD_START_INDEX, DASHBOARD_STEPS).select("hour").scalar()
    b = op.balance_from_flow(flow, as_of=hour, member=active_flag() == 1)
    b = op.with_adjustments(b, adjustments_from_events(events(spark, sf_dir)))
    return b.select("station_id", "station_name", "balance")


def _trips_until(trips: DataFrame, hour: str) -> DataFrame:
    """Valid trips that can have a leg in or before ``hour``: they start before its end. The bound reaches the scan."""
    return trips.where(F.col("started_at") < F.lit(hour).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR"))


def _text_date(c: str = "date"):
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


# --- trips and profiles ---
@query
def trips_clean(spark, sf_dir):
    return clean(spark, sf_dir).select("ride_id", "rideable_type", "start_station_id", "end_station_id")


@query
def usable_trips(spark, sf_dir):
    return op.usable_trip_summary(norm_trips(spark, sf_dir))


@query
def bike_type_counts(spark, sf_dir):
    return op.bike_type_counts(norm_trips(spark, sf_dir))


@query
def trip_sample(spark, sf_dir):
    return op.trip_sample(norm_trips(spark, sf_dir), 5)


@query
def trip_date_range(spark, sf_dir):
    return op.trip_date_range(norm_trips(spark, sf_dir))


@query
def distinct_station_counts(spark, sf_dir):
    return op.distinct_station_counts(norm_trips(spark, sf_dir))


@query
def null_station_summary(spark, sf_dir):
    return op.null_station_summary(norm_trips(spark, sf_dir))


@query
def null_station_by_type(spark, sf_dir):
    return op.null_station_by_type(norm_trips(spark, sf_dir))


# --- catalogue and flow ---
@query
def station_catalog(spark, sf_dir):
    return catalog(spark, sf_dir)


@query
def station_name_pairs(spark, sf_dir):
    return op.station_name_pairs(norm_trips(spark, sf_dir))


@query
def hourly_deltas(spark, sf_dir):
    return deltas(spark, sf_dir)


@query
def hourly_deltas_by_class(spark, sf_dir):
    return op.hourly_deltas(clean(spark, sf_dir), by_class=True)


@query
def hourly_arrivals_departures(spark, sf_dir):
    return op.arrivals_departures(clean(spark, sf_dir))


@query
def net_flow_by_station(spark, sf_dir):
    # exploratory form: every leg with a station counts, also of trips that cleaning rejects
    return op.net_flow_by_station(norm_trips(spark, sf_dir))


def _daily(spark, sf_dir):
    return op.daily_net_flow(norm_trips(spark, sf_dir))


@query
def daily_net_flow(spark, sf_dir):
    return _daily(spark, sf_dir).select(_text_date(), "station_id", "difference")


@query
def daily_top_added(spark, sf_dir):
    top = op.day_top(_daily(spark, sf_dir), REPORT_DAY, DAILY_TOP_K, largest=True)
    return top.select(_text_date(), "station_id", "difference")


@query
def daily_top_all(spark, sf_dir):
    top = op.top_per_day(_daily(spark, sf_dir), DAILY_TOP_K)
    return top.select(_text_date(), "station_id", "difference", "rank")


@query
def daily_top_removed(spark, sf_dir):
    top = op.day_top(_daily(spark, sf_dir), REPORT_DAY, DAILY_TOP_K, largest=False)
    return top.select(_text_date(), "station_id", "difference")


def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly flow with named-leg and trip counts: the one aggregate several summaries derive from."""
    return op.flow_with_counts(clean(spark, sf_dir))


@query
def orphan_station_events(spark, sf_dir):
    # one aggregate (op.orphan_station_events is the same check as an anti join against a stored table)
    return op.unnamed_stations(flow(spark, sf_dir))


# --- station table lookups ---
def _station_cols(df):
    return df.select("id", "name", "capacity", "is_active")


@query
def station_lookup(spark, sf_dir):
    return _station_cols(stations(spark, sf_dir).where(F.col("id") == LOOKUP_STATION))


@query
def active_stations(spark, sf_dir):
    return _station_cols(stations(spark, sf_dir).where(F.col("is_active") == 1))


# --- balances ---
@query
def station_balance(spark, sf_dir):
    return balance(spark, sf_dir)


@query
def balances_as_of(spark, sf_dir):
    # catalogue over all trips, flow bounded by the hour: one aggregation (op.balances_as_of does the same from
    # stored tables)
    b = op.balance_from_trips(clean(spark, sf_dir), as_of=AS_OF_HOUR, member=active_flag() == 1)
    return b.select("station_id", "station_name", "balance")


@query
def balance_of_station(spark, sf_dir):
    d = op.hourly_deltas(_trips_until(clean(spark, sf_dir), LOOKUP_HOUR))
    return op.balance_of_station(d, LOOKUP_STATION, LOOKUP_HOUR)


@query
def station_events_range(spark, sf_dir):
    d = op.hourly_deltas(_trips_until(clean(spark, sf_dir), RANGE_END))
    return op.station_events_range(d, LOOKUP_STATION, RANGE_START, RANGE_END)


@query
def station_events_since(spark, sf_dir):
    return op.station_events_range(deltas(spark, sf_dir), LOOKUP_STATION, start_hour=RANGE_START)


@query
def station_events_until(spark, sf_dir):
    d = op.hourly_deltas(_trips_until(clean(spark, sf_dir), RANGE_END))
    return op.station_events_range(d, LOOKUP_STATION, end_hour=RANGE_END)


@query
def running_balance(spark, sf_dir):
    return op.running_balance(deltas(spark, sf_dir))


@query
def running_balance_by_day(spark, sf_dir):
    return op.running_balance_by_day(deltas(spark, sf_dir))


@query
def worst_station_series(spark, sf_dir):
    # Both branches read the same hourly aggregate. The series branch also references named_legs, so column
    # pruning leaves the two aggregates identical and Spark computes them once (ReusedExchange).
    f = flow(spark, sf_dir).select("hour", "station_id", "delta_total", "named_legs")
    totals = op.station_flow_totals(f).where((F.col("named_legs") > 0) & (active_flag() == 1))
    worst = op.worst_station(totals)
    series = op.running_balance(f.where(F.col("named_legs") >= 0))
    # the right side is one row by construction (limit 1): broadcasting it is bounded
    return series.join(F.broadcast(worst), "station_id", "left_semi").select(
        "hour", "station_id", "delta_total", "balance"
    )


@query
def balances_adjusted(spark, sf_dir):
    return adjusted(spark, sf_dir)


@query
def hour_at_step(spark, sf_dir):
    return op.hour_at_step(deltas(spark, sf_dir), DASHBOARD_START_INDEX, DASHBOARD_STEPS)


@query
def latest_balance(spark, sf_dir):
    return op.latest_balance(op.running_balance(deltas(spark, sf_dir)))


@query
def balance_carry_over(spark, sf_dir):
    # op.carry_over_balance(new_slice, earlier_balances) is the form for a stored balance table
    return op.carry_over_at(deltas(spark, sf_dir), CARRY_FROM)


# --- insight ---
@query
def critical_stations(spark, sf_dir):
    return op.critical_stations(balance(spark, sf_dir))


@query
def critical_stations_first(spark, sf_dir):
    """The report's short lists: first 15 low and first 15 high stations by descending net change."""
    return op.critical_stations(balance(spark, sf_dir), limit=CRITICAL_LIST_LIMIT)


@query
def balance_alerts(spark, sf_dir):
    return op.balance_alerts(adjusted(spark, sf_dir))


@query
def rebalancing_summary(spark, sf_dir):
    return op.rebalancing_summary(balance(spark, sf_dir))


@query
def balance_stats(spark, sf_dir):
    return op.balance_stats(balance(spark, sf_dir))


@query
def balance_stats_by_selection(spark, sf_dir):
    return op.balance_stats_by_selection(balance(spark, sf_dir))


@query
def balance_histogram(spark, sf_dir):
    return op.balance_histogram(balance(spark, sf_dir))


@query
def surplus_deficit_top(spark, sf_dir):
    return op.surplus_deficit_top(balance(spark, sf_dir))


@query
def below_initial_top(spark, sf_dir):
    return op.below_initial_top(adjusted(spark, sf_dir))


@query
def above_initial_top(spark, sf_dir):
    return op.above_initial_top(adjusted(spark, sf_dir))


@query
def balance_labels(spark, sf_dir):
    return op.balance_labels(adjusted(spark, sf_dir))


# --- status and summaries ---
@query
def table_status(spark, sf_dir):
    return op.flow_status(flow(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return op.flow_run_summary(flow(spark, sf_dir), member=active_flag() == 1)


@query
def source_inventory(spark, sf_dir):
    return file_inventory(events(spark, sf_dir))


@query
def batch_job(spark, sf_dir):
    """The batch job into fresh tables; its one-row summary counts this load."""
    return run_batch(spark, raw_trips(spark, sf_dir), scratch_path(spark, "batch-job"), F.lit(OLD_CREATED).cast("timestamp"))


# --- upserts ---
def _trips_between(spark, sf_dir, start=None, end=None):
    c = clean(spark, sf_dir)
    if start is not None:
        c = c.where(F.col("started_at") >= F.lit(start))
    if end is not None:
        c = c.where(F.col("started_at") < F.lit(end))
    return c


@query
def upsert_stations(spark, sf_dir):
    old = station_table(
        op.station_catalog(_trips_between(spark, sf_dir, end=UPSERT_OLD_BEFORE)),
        created_at=F.lit(OLD_CREATED).cast("timestamp"),
        capacity=F.lit(OLD_CAPACITY),
    )
    new = op.station_catalog(_trips_between(spark, sf_dir, start=UPSERT_NEW_FROM)).select(
        F.col("station_id").alias("id"), F.col("station_name").alias("name")
    )
    merged = op.merge_stations(old, new, F.lit(NEW_CREATED).cast("timestamp"))
    return merged.select(
        "id", "name", "capacity", "is_active",
        F.date_format("created_at_utc", "yyyy-MM-dd HH:mm:ss").alias("created_at_utc"),
    )


@query
def upsert_deltas(spark, sf_dir):
    old = op.hourly_deltas(_trips_between(spark, sf_dir, end=UPSERT_OLD_BEFORE))
    new = op.hourly_deltas(_trips_between(spark, sf_dir, start=UPSERT_NEW_FROM))
    return op.merge_deltas(old, new).select("hour", "station_id", "delta_total")


# --- CSV source ---
def _landed_csv(spark, sf_dir) -> str:
    """Adapter A written as header CSV to a fresh folder below the shared checkpoint root."""
    return write_trips_csv(raw_trips(spark, sf_dir), scratch_path(spark, "trips-csv"))


@query
def csv_inferred_shape(spark, sf_dir):
    return shape_of(read_trips_csv_inferred(spark, _landed_csv(spark, sf_dir)))


@query
def csv_round_trip(spark, sf_dir):
    return op.hourly_deltas(op.clean_trips(read_trips_csv(spark, _landed_csv(spark, sf_dir))))


@query
def csv_quarantine(spark, sf_dir):
    """Ride ids of the records that the declared schema cannot read: the trips as CSV, some with a start that is no time."""
    event = F.substring("ride_id", 2, 20).cast("bigint")
    trips = raw_trips(spark, sf_dir)
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if t == "timestamp" else F.col(c).cast("string") for c, t in trips.dtypes]
    broken = F.when(event % MALFORMED_EVERY == MALFORMED_AT, "not a time").otherwise(F.col("started_at"))
    columns = [F.col(f.name) if f.name in trips.columns else F.lit(None).cast("string").alias(f.name) for f in TRIP_SCHEMA.fields]
    path = scratch_path(spark, "trips-malformed")
    trips.select(*text).withColumn("started_at", broken).select(*columns).write.option("header", True).csv(path)
    return read_trips_csv_quarantine(spark, path)[1].select(F.split("record", ",")[0].alias("ride_id"))


# --- stored tables: loaded through the table store, then only the tables are read ---
_LOADED: dict[tuple[str, str, str], str] = {}


def _tables(spark: SparkSession, sf_dir: str) -> FlowTables:
    """Station and flow tables with all trips of ``sf_dir``, loaded once per application and folder (a side effect of the
    first query that asks for them)."""
    key = (spark.sparkContext.applicationId, sf_dir, "all")
    if key not in _LOADED:
        tables = FlowTables(spark, scratch_path(spark, "tables")).create()
        tables.upsert_stations(stations(spark, sf_dir))
        tables.upsert_deltas(op.hourly_deltas(clean(spark, sf_dir), by_class=True))
        tables.snapshot_totals()
        _LOADED[key] = tables.root
    return FlowTables(spark, _LOADED[key])


def _tables_twice(spark: SparkSession, sf_dir: str) -> FlowTables:
    """Tables after three loads: the old trips, the new ones (both have trips of the days between), the new ones again."""
    key = (spark.sparkContext.applicationId, sf_dir, "twice")
    if key not in _LOADED:
        tables = FlowTables(spark, scratch_path(spark, "tables-twice")).create()
        old, new = _trips_between(spark, sf_dir, end=UPSERT_OLD_BEFORE), _trips_between(spark, sf_dir, start=UPSERT_NEW_FROM)
        first = station_table(op.station_catalog(old), capacity=F.lit(OLD_CAPACITY)).drop("created_at_utc")
        second = op.station_catalog(new).select(F.col("station_id").alias("id"), F.col("station_name").alias("name"))
        tables.upsert_stations(first, F.lit(OLD_CREATED).cast("timestamp"))
        tables.upsert_deltas(op.hourly_deltas(old))
        for _ in range(2):
            tables.upsert_stations(second, F.lit(NEW_CREATED).cast("timestamp"))
            tables.upsert_deltas(op.hourly_deltas(new))
        _LOADED[key] = tables.root
    return FlowTables(spark, _LOADED[key])


def _tables_late(spark: SparkSession, sf_dir: str) -> FlowTables:
    """Tables whose totals were summed up before every fifth event came; its flow was added later, to hours of all days."""
    key = (spark.sparkContext.applicationId, sf_dir, "late")
    if key not in _LOADED:
        tables = FlowTables(spark, scratch_path(spark, "tables-late")).create()
        late = F.col("event_id") % LATE_EVERY == 0
        first, second = (op.hourly_deltas(op.clean_trips(events_as_trips(events(spark, sf_dir).where(c)))) for c in (~late, late))
        tables.upsert_stations(stations(spark, sf_dir))
        tables.upsert_deltas(first)
        tables.snapshot_totals()
        tables.upsert_deltas(second, mode="add")
        _LOADED[key] = tables.root
    return FlowTables(spark, _LOADED[key])


def _tables_after_delete(spark: SparkSession, sf_dir: str) -> FlowTables:
    """Tables from which some stations were deleted together with their flow."""
    key = (spark.sparkContext.applicationId, sf_dir, "delete")
    if key not in _LOADED:
        tables = FlowTables(spark, scratch_path(spark, "tables-delete")).create()
        tables.upsert_stations(stations(spark, sf_dir))
        tables.upsert_deltas(deltas(spark, sf_dir))
        tables.delete_stations(tables.stations().where(F.col("id").endswith(DELETED_SUFFIX)))
        _LOADED[key] = tables.root
    return FlowTables(spark, _LOADED[key])


@query
def table_upsert_twice(spark, sf_dir):
    return _tables_twice(spark, sf_dir).deltas().select("hour", "station_id", "delta_total")


@query
def table_upsert_stations_twice(spark, sf_dir):
    created = F.date_format("created_at_utc", "yyyy-MM-dd HH:mm:ss").alias("created_at_utc")
    return _tables_twice(spark, sf_dir).stations().select("id", "name", "capacity", "is_active", created)


@query
def table_active_stations(spark, sf_dir):
    return _station_cols(_tables(spark, sf_dir).stations(active_only=True, ordered=True))


@query
def table_station_lookup(spark, sf_dir):
    return _station_cols(_tables(spark, sf_dir).stations().where(F.col("id") == LOOKUP_STATION))


@query
def table_station_range(spark, sf_dir):
    d = _tables(spark, sf_dir).deltas(until=RANGE_END, since=RANGE_START, station=LOOKUP_STATION)
    return op.station_events_range(d, LOOKUP_STATION, RANGE_START, RANGE_END).orderBy("hour")


@query
def table_hourly_events(spark, sf_dir):
    found = _tables(spark, sf_dir).hourly_events(until=RANGE_END, since=RANGE_START)
    return found.select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), "station_id", "delta").orderBy("hour", "station_id")


@query
def table_balances_as_of(spark, sf_dir):
    return _tables(spark, sf_dir).balances_as_of(AS_OF_HOUR)


@query
def table_balances_as_of_late(spark, sf_dir):
    """Totals of the days before, the changes that a later load made to them, and the hours of the day."""
    return _tables_late(spark, sf_dir).balances_as_of(AS_OF_HOUR)


@query
def table_delete_cascade(spark, sf_dir):
    return _tables_after_delete(spark, sf_dir).deltas().select("hour", "station_id", "delta_total")


@query
def table_delete_cascade_stations(spark, sf_dir):
    return _station_cols(_tables_after_delete(spark, sf_dir).stations())


@query
def table_add_twice(spark, sf_dir):
    """The flow after the same trip files were added twice."""
    path = _landed_csv(spark, sf_dir)
    tables = FlowTables(spark, scratch_path(spark, "tables-add")).create()
    for _ in range(2):
        tables.add_trip_files(path, lambda files: read_trips_csv(spark, files))
    return tables.deltas().select("hour", "station_id", "delta_total")


@query
def table_balances_at_step(spark, sf_dir):
    t = _tables(spark, sf_dir)
    adjustments = adjustments_from_events(events(spark, sf_dir))
    return op.balances_at_step(t.stations(), t.deltas(), DASHBOARD_START_INDEX, DASHBOARD_STEPS, adjustments=adjustments)


@query
def table_stored_status(spark, sf_dir):
    return _tables(spark, sf_dir).status()


@query
def table_orphans(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return op.orphan_station_events(t.deltas(), t.stations())


@query
def table_balance_carry_over(spark, sf_dir):
    """The balance of every station before the cut is stored; only the hours from the cut on are read from the table."""
    t = _tables(spark, sf_dir)
    before = op.latest_balance(op.running_balance(t.deltas().where(F.col("hour") < CARRY_FROM)))
    return op.carry_over_balance(t.deltas(since=CARRY_FROM), t.stage(before, "balances"))


# --- streaming: the events, landed part by part; the stream takes each part and stops (availableNow), then goes on from its checkpoint ---
def _part(k: int):
    """Events of part k: every fourth day of the month (rows without a time are in part 0), so later parts hold earlier days too."""
    return F.pmod(F.coalesce(F.dayofmonth("ts"), F.lit(0)), F.lit(STREAM_FILES)) == k


def _stream_parts(spark, sf_dir, start, between=None) -> None:
    """Land each part with its natural files and run the stream that ``start`` makes of (landing folder, checkpoint). Calling a ``stream_*`` query runs its stream."""
    root = scratch_path(spark, "stream")
    for k in range(STREAM_FILES):
        if k == STREAM_FILES - 1 and between is not None:
            between()
        events(spark, sf_dir).where(_part(k)).write.mode("append").parquet(f"{root}/landing")
        run_available(start(events_as_trips(read_events_stream(spark, f"{root}/landing")), f"{root}/checkpoint"))


def _stream_sink(spark, sf_dir, compact_before_last: bool = False) -> FlowStreamSink:
    sink = FlowStreamSink(spark, scratch_path(spark, "flow-stream"))
    _stream_parts(spark, sf_dir, lambda trips, at: start_flow_stream(trips, sink, at, available_now=True), sink.compact if compact_before_last else None)
    return sink


@query
def stream_hourly_deltas(spark, sf_dir):
    sink = _stream_sink(spark, sf_dir)
    sink.compact()
    return sink.deltas().select("hour", "station_id", "delta_total")


@query
def stream_balance(spark, sf_dir):
    return _stream_sink(spark, sf_dir).balances(initial=0)


@query
def stream_balance_open(spark, sf_dir):
    """The balances that the last part changes on its days, on top of a base of the parts before; it holds days between those of the base."""
    return _stream_sink(spark, sf_dir, compact_before_last=True).open_balances()


@query
def stream_windowed_deltas(spark, sf_dir):
    """Closed and open windows and the late path added up; the later parts hold days before the watermark."""
    sink = WindowSink(spark, scratch_path(spark, "window-stream"), WINDOW_DELAY)
    _stream_parts(spark, sf_dir, lambda trips, at: start_window_stream(trips, sink, at, available_now=True))
    return sink.deltas()


@query
def stream_csv_deltas(spark, sf_dir):
    """Trips landed as CSV files and read as a stream with the declared schema."""
    sink = FlowStreamSink(spark, scratch_path(spark, "csv-stream"))
    path = _landed_csv(spark, sf_dir)
    run_available(start_flow_stream(read_trips_stream(spark, path, max_files_per_trigger=2), sink, scratch_path(spark, "csv-checkpoint"), available_now=True))
    return sink.deltas().select("hour", "station_id", "delta_total")


@query
def stream_station_pairs(spark, sf_dir):
    out = scratch_path(spark, "pairs-stream")

    def start(trips, at):
        writer = distinct_pairs_stream(trips).writeStream.format("parquet").option("path", out).option("checkpointLocation", at)
        return writer.outputMode("append").trigger(availableNow=True).start()

    _stream_parts(spark, sf_dir, start)
    return spark.read.schema("station_id string, station_name string").parquet(out)


# --- adapter B: shipments between nations, day grain ---
def shipments(spark, sf_dir):
    t = {n: read_table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "supplier")}
    return shipments_as_trips(t["lineitem"], t["orders"], t["customer"], t["supplier"])


def _shipment_daily(spark, sf_dir):
    legs = op.flow_legs(op.valid_trips(shipments(spark, sf_dir)))
    daily = op.bucketed_deltas(legs, grain="day")
    return daily.select("date", nation_station("station_id").alias("station_id"), "delta_total")


@query
def shipment_daily_flow(spark, sf_dir):
    return _shipment_daily(spark, sf_dir).select(
        _text_date(), "station_id", F.col("delta_total").alias("net")
    )


@query
def shipment_balance(spark, sf_dir):
    daily = _shipment_daily(spark, sf_dir).select(
        _text_date().alias("hour"), "station_id", "delta_total"
    )
    rb = op.running_balance(daily, INITIAL_BALANCE)
    return rb.select(
        F.col("hour").alias("date"), "station_id", F.col("delta_total").alias("net"), "balance"
    )


@query
def shipment_nation_balance(spark, sf_dir):
    """Balance of every nation (the catalogue is the nation table): flow summed per nation first, then joined
    to the 25-row dimension."""
    nations = nation_catalog(read_table(spark, sf_dir, "nation")).select(
        F.col("station_id").alias("id"), F.col("station_name").alias("name"), F.lit(1).alias("is_active")
    )
    flow = _shipment_daily(spark, sf_dir)
    return op.overall_balance(nations, flow)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_balance(spark, sf_dir)
