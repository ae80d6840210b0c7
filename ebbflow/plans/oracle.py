"""Equivalent DuckDB SQL for each named query (the correctness oracle).

Every statement is a fresh WITH-chain over the registered tables. DuckDB notes: ``trim(x, ' ')`` matches
Spark's space-only trim, sums are cast to BIGINT, floats are rounded to 6 digits as on the Spark side, and
dates/times are compared as text.
"""

from __future__ import annotations

from ebbflow.config import CRITICAL_LIST_LIMIT, HIGH_THRESHOLD, HISTOGRAM_BINS, LOW_THRESHOLD, TOP_K
from ebbflow.plans import catalog as q

HOUR = "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00')"


def _legs(src: str, sign: int = 1) -> str:
    return f"""
  SELECT started_at AS ts, start_station_id AS station_id, start_station_name AS station_name,
         rideable_type, {-sign} AS delta
  FROM {src} WHERE start_station_id IS NOT NULL
  UNION ALL
  SELECT ended_at, end_station_id, end_station_name, rideable_type, {sign}
  FROM {src} WHERE end_station_id IS NOT NULL"""


def _catalog(legs: str) -> str:
    return f"SELECT station_id, min(station_name) AS station_name FROM {legs} WHERE station_name IS NOT NULL GROUP BY 1"


def _deltas(legs: str) -> str:
    return f"SELECT {HOUR} AS hour, station_id, CAST(sum(delta) AS BIGINT) AS delta_total FROM {legs} GROUP BY 1, 2"


ACTIVE_RULE = "CASE WHEN TRY_CAST(substr(station_id, 2) AS INTEGER) % 10 = 9 THEN 0 ELSE 1 END"

BASE = f"""
WITH src AS (
  SELECT *, TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) % 100 AS c2
  FROM events),
trips AS (
  SELECT 'R' || event_id AS ride_id,
    CASE event_type WHEN 'click' THEN 'electric_bike' WHEN 'view' THEN 'electric_bike'
      WHEN 'purchase' THEN 'classic_bike' WHEN 'signup' THEN 'docked_bike' ELSE '  ' END AS rideable_type,
    ts AS started_at,
    CASE WHEN event_id % 50 = 7 THEN NULL
      ELSE ts + to_minutes(CAST(event_id % 97 - 3 AS INTEGER)) END AS ended_at,
    CASE WHEN k % 17 = 5 THEN NULL WHEN event_id % 11 = 0 THEN 'Station ' || k || ' (temp)'
      ELSE 'Station ' || k END AS start_station_name,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '' ELSE ' S' || k || ' ' END AS start_station_id,
    CASE WHEN c2 % 17 = 5 THEN NULL WHEN event_id % 13 = 0 THEN 'Station ' || c2 || ' (temp)'
      ELSE 'Station ' || c2 END AS end_station_name,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN '   ' ELSE 'S' || c2 END AS end_station_id
  FROM src),
norm AS (
  SELECT ride_id, nullif(trim(rideable_type, ' '), '') AS rideable_type, started_at, ended_at,
    nullif(trim(start_station_name, ' '), '') AS start_station_name,
    nullif(trim(start_station_id, ' '), '') AS start_station_id,
    nullif(trim(end_station_name, ' '), '') AS end_station_name,
    nullif(trim(end_station_id, ' '), '') AS end_station_id
  FROM trips),
clean AS (
  SELECT * FROM norm
  WHERE started_at IS NOT NULL AND ended_at IS NOT NULL AND ended_at >= started_at
    AND (start_station_id IS NOT NULL OR end_station_id IS NOT NULL)),
legs AS ({_legs("clean")}),
flip AS ({_legs("norm", -1)}),
deltas AS ({_deltas("legs")}),
catalog AS ({_catalog("legs")}),
stations AS (
  SELECT station_id AS id, station_name AS name, CAST(NULL AS INTEGER) AS capacity, {ACTIVE_RULE} AS is_active
  FROM catalog),
totals AS (SELECT station_id, CAST(sum(delta_total) AS BIGINT) AS net_change FROM deltas GROUP BY 1),
balance AS (
  SELECT s.id AS station_id, s.name AS station_name, COALESCE(t.net_change, 0) AS net_change,
         CAST({q.INITIAL_BALANCE} + COALESCE(t.net_change, 0) AS BIGINT) AS final_balance
  FROM stations s LEFT JOIN totals t ON s.id = t.station_id WHERE s.is_active = 1),
running AS (
  SELECT station_id, hour, delta_total,
    CAST({q.INITIAL_BALANCE} + sum(delta_total) OVER (PARTITION BY station_id ORDER BY hour
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS balance
  FROM deltas),
hours AS (SELECT DISTINCT hour FROM deltas),
idx AS (SELECT CAST(row_number() OVER (ORDER BY hour) - 1 AS BIGINT) AS hour_index, hour FROM hours),
step AS (
  SELECT hour_index, hour FROM idx
  WHERE hour_index = (SELECT least({q.DASHBOARD_START_INDEX + q.DASHBOARD_STEPS}, count(*) - 1) FROM hours)),
adj AS (
  SELECT station_id, CAST(sum(amount) AS BIGINT) AS adjustment FROM (
    SELECT 'S' || (event_id % 100) AS station_id, event_id % 7 - 3 AS amount FROM events
    WHERE event_type = 'signup') GROUP BY 1),
adjusted AS (
  SELECT s.id AS station_id, s.name AS station_name,
    CAST({q.INITIAL_BALANCE} + COALESCE(t.net, 0) + COALESCE(a.adjustment, 0) AS BIGINT) AS balance
  FROM stations s
  LEFT JOIN (SELECT station_id, sum(delta_total) AS net FROM deltas
             WHERE hour <= (SELECT hour FROM step) GROUP BY 1) t ON s.id = t.station_id
  LEFT JOIN adj a ON s.id = a.station_id
  WHERE s.is_active = 1),
daily AS (
  SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, station_id, CAST(sum(delta) AS BIGINT) AS difference
  FROM flip WHERE ts IS NOT NULL GROUP BY 1, 2)
"""

SHIP = """
WITH ship AS (
  SELECT o.o_orderdate AS started_at, l.l_shipdate AS ended_at,
         'N' || s.s_nationkey AS start_station_id, 'N' || c.c_nationkey AS end_station_id
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
sclean AS (
  SELECT * FROM ship
  WHERE started_at IS NOT NULL AND ended_at IS NOT NULL AND ended_at >= started_at),
slegs AS (
  SELECT started_at AS ts, start_station_id AS station_id, -1 AS delta FROM sclean
  WHERE start_station_id IS NOT NULL
  UNION ALL
  SELECT ended_at, end_station_id, 1 FROM sclean WHERE end_station_id IS NOT NULL),
sdaily AS (
  SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, station_id, CAST(sum(delta) AS BIGINT) AS net
  FROM slegs GROUP BY 1, 2)
"""


def _pct(part: str, total: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100.0 / {total}, 6)"


def _distinct_with_null(c: str) -> str:
    return f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"


def _upsert_parts() -> str:
    old_src = f"(SELECT * FROM clean WHERE started_at < TIMESTAMP '{q.UPSERT_OLD_BEFORE}')"
    new_src = f"(SELECT * FROM clean WHERE started_at >= TIMESTAMP '{q.UPSERT_NEW_FROM}')"
    return f""",
old_legs AS ({_legs(old_src)}),
new_legs AS ({_legs(new_src)})"""


_BINS = HISTOGRAM_BINS

PAIRS = """
SELECT DISTINCT station_id, station_name FROM (
  SELECT start_station_id AS station_id, start_station_name AS station_name FROM norm
  UNION ALL SELECT end_station_id, end_station_name FROM norm)
WHERE station_id IS NOT NULL AND station_name IS NOT NULL"""

SELECTS: dict[str, str] = {
    "trips_clean": "SELECT ride_id, rideable_type, start_station_id, end_station_id FROM clean",
    "usable_trips": f"""
SELECT total, usable, total - usable AS excluded, {_pct("usable", "total")} AS usable_pct FROM (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL) AS usable
  FROM norm)""",
    "bike_type_counts": 'SELECT rideable_type, count(*) AS "count" FROM norm GROUP BY 1',
    "trip_sample": """
SELECT ride_id, rideable_type, start_station_id, start_station_name, end_station_id, end_station_name
FROM norm ORDER BY ride_id LIMIT 5""",
    "trip_date_range": """
SELECT strftime(min(started_at), '%Y-%m-%d %H:%M:%S.%f') AS earliest_trip,
       strftime(max(ended_at), '%Y-%m-%d %H:%M:%S.%f') AS latest_trip FROM norm""",
    "distinct_station_counts": f"""
SELECT {_distinct_with_null("start_station_id")} AS start_stations,
       {_distinct_with_null("end_station_id")} AS end_stations FROM norm""",
    "null_station_summary": f"""
SELECT total, null_start, null_end, null_any,
  {_pct("null_start", "total")} AS null_start_pct, {_pct("null_end", "total")} AS null_end_pct,
  {_pct("null_any", "total")} AS null_any_pct
FROM (SELECT count(*) AS total,
  count(*) FILTER (WHERE start_station_id IS NULL) AS null_start,
  count(*) FILTER (WHERE end_station_id IS NULL) AS null_end,
  count(*) FILTER (WHERE start_station_id IS NULL OR end_station_id IS NULL) AS null_any FROM norm)""",
    "null_station_by_type": f"""
SELECT rideable_type, total_trips, null_start, null_end,
  {_pct("null_start", "total_trips")} AS null_start_pct, {_pct("null_end", "total_trips")} AS null_end_pct
FROM (SELECT rideable_type, count(*) AS total_trips,
  count(*) FILTER (WHERE start_station_id IS NULL) AS null_start,
  count(*) FILTER (WHERE end_station_id IS NULL) AS null_end FROM norm GROUP BY 1)""",
    "station_catalog": "SELECT station_id, station_name FROM catalog",
    "station_name_pairs": PAIRS,
    "stream_station_pairs": PAIRS,
    "hourly_deltas": "SELECT hour, station_id, delta_total FROM deltas",
    "hourly_deltas_by_class": f"""
SELECT {HOUR} AS hour, station_id, CAST(sum(delta) AS BIGINT) AS delta_total,
  CAST(sum(CASE WHEN rideable_type = 'electric_bike' THEN delta ELSE 0 END) AS BIGINT) AS delta_ebike,
  CAST(sum(CASE WHEN rideable_type = 'electric_bike' THEN 0 ELSE delta END) AS BIGINT) AS delta_other
FROM legs GROUP BY 1, 2""",
    "hourly_arrivals_departures": f"""
SELECT station_id, hour, arrivals, departures, arrivals - departures AS delta FROM (
  SELECT station_id, {HOUR} AS hour, count(*) FILTER (WHERE delta > 0) AS arrivals,
         count(*) FILTER (WHERE delta < 0) AS departures
  FROM legs GROUP BY 1, 2)""",
    "net_flow_by_station": "SELECT station_id, CAST(sum(delta) AS BIGINT) AS difference FROM flip GROUP BY 1",
    "daily_net_flow": "SELECT date, station_id, difference FROM daily",
    "daily_top_added": f"""
SELECT date, station_id, difference FROM daily WHERE date = '{q.REPORT_DAY}'
ORDER BY difference DESC, station_id LIMIT {q.DAILY_TOP_K}""",
    "daily_top_removed": f"""
SELECT date, station_id, difference FROM daily WHERE date = '{q.REPORT_DAY}'
ORDER BY difference ASC, station_id LIMIT {q.DAILY_TOP_K}""",
    "orphan_station_events": """
SELECT station_id, count(*) AS "rows" FROM deltas d
WHERE NOT EXISTS (SELECT 1 FROM stations s WHERE s.id = d.station_id) GROUP BY 1""",
    "station_lookup": f"SELECT id, name, capacity, is_active FROM stations WHERE id = '{q.LOOKUP_STATION}'",
    "active_stations": "SELECT id, name, capacity, is_active FROM stations WHERE is_active = 1",
    "station_balance": "SELECT station_id, station_name, net_change, final_balance FROM balance",
    "balances_as_of": f"""
SELECT s.id AS station_id, s.name AS station_name,
  CAST({q.INITIAL_BALANCE} + COALESCE(t.net, 0) AS BIGINT) AS balance
FROM stations s
LEFT JOIN (SELECT station_id, sum(delta_total) AS net FROM deltas WHERE hour <= '{q.AS_OF_HOUR}' GROUP BY 1) t
  ON s.id = t.station_id
WHERE s.is_active = 1""",
    "balance_of_station": f"""
SELECT '{q.LOOKUP_STATION}' AS station_id,
  CAST({q.INITIAL_BALANCE} + COALESCE(sum(delta_total), 0) AS BIGINT) AS balance
FROM deltas WHERE station_id = '{q.LOOKUP_STATION}' AND hour <= '{q.LOOKUP_HOUR}'""",
    "station_events_range": f"""
SELECT hour, station_id, delta_total FROM deltas
WHERE station_id = '{q.LOOKUP_STATION}' AND hour >= '{q.RANGE_START}' AND hour <= '{q.RANGE_END}'""",
    "station_events_since": f"""
SELECT hour, station_id, delta_total FROM deltas
WHERE station_id = '{q.LOOKUP_STATION}' AND hour >= '{q.RANGE_START}'""",
    "station_events_until": f"""
SELECT hour, station_id, delta_total FROM deltas
WHERE station_id = '{q.LOOKUP_STATION}' AND hour <= '{q.RANGE_END}'""",
    "critical_stations_first": f"""
(SELECT 'low' AS kind, station_id, final_balance FROM balance WHERE final_balance <= {LOW_THRESHOLD}
 ORDER BY net_change DESC, station_id LIMIT {CRITICAL_LIST_LIMIT})
UNION ALL
(SELECT 'high', station_id, final_balance FROM balance WHERE final_balance >= {HIGH_THRESHOLD}
 ORDER BY net_change DESC, station_id LIMIT {CRITICAL_LIST_LIMIT})""",
    "running_balance": "SELECT station_id, hour, delta_total, balance FROM running",
    "worst_station_series": """
SELECT hour, station_id, delta_total, balance FROM running
WHERE station_id = (SELECT station_id FROM balance ORDER BY net_change, station_id LIMIT 1)""",
    "balances_adjusted": "SELECT station_id, station_name, balance FROM adjusted",
    "hour_at_step": "SELECT hour_index, hour FROM step",
    "latest_balance": """
SELECT station_id, max(hour) AS hour, arg_max(balance, hour) AS balance FROM running GROUP BY 1""",
    "balance_carry_over": f"""
SELECT station_id, hour, balance FROM running WHERE hour >= '{q.CARRY_FROM}'""",
    "critical_stations": f"""
SELECT 'low' AS kind, station_id, final_balance FROM balance WHERE final_balance <= {LOW_THRESHOLD}
UNION ALL
SELECT 'high', station_id, final_balance FROM balance WHERE final_balance >= {HIGH_THRESHOLD}""",
    "balance_alerts": f"""
SELECT CASE WHEN balance < {LOW_THRESHOLD} THEN 'low' ELSE 'high' END AS kind, station_id,
  concat_ws(' ', station_name, '—', CAST(balance AS VARCHAR), 'bikes') AS message
FROM adjusted WHERE balance < {LOW_THRESHOLD} OR balance > {HIGH_THRESHOLD}""",
    "rebalancing_summary": f"""
SELECT low_count, high_count, abs(low_sum) AS deficit, high_sum AS surplus, high_sum + low_sum AS net FROM (
  SELECT count(*) FILTER (WHERE final_balance <= {LOW_THRESHOLD}) AS low_count,
         count(*) FILTER (WHERE final_balance >= {HIGH_THRESHOLD}) AS high_count,
         CAST(COALESCE(sum(net_change) FILTER (WHERE final_balance <= {LOW_THRESHOLD}), 0) AS BIGINT) AS low_sum,
         CAST(COALESCE(sum(net_change) FILTER (WHERE final_balance >= {HIGH_THRESHOLD}), 0) AS BIGINT) AS high_sum
  FROM balance)""",
    "balance_stats": """
SELECT round(avg(final_balance), 6) AS mean,
       round(CAST(quantile_cont(final_balance, 0.5) AS DOUBLE), 6) AS median,
       round(stddev_samp(final_balance), 6) AS std,
       CAST(min(final_balance) AS BIGINT) AS min, CAST(max(final_balance) AS BIGINT) AS max
FROM balance""",
    "balance_histogram": f"""
, mm AS (SELECT min(final_balance) AS lo, max(final_balance) AS hi, count(final_balance) AS n FROM balance),
geo AS (SELECT lo, hi, n, CASE WHEN hi = lo THEN lo - 0.5 ELSE CAST(lo AS DOUBLE) END AS edge0,
               CASE WHEN hi = lo THEN 1.0 ELSE CAST(hi - lo AS DOUBLE) END AS span FROM mm),
binned AS (
  SELECT CAST(CASE WHEN hi = lo THEN {_BINS // 2}
    ELSE least({_BINS - 1}, floor(CAST((final_balance - lo) * {_BINS} AS DOUBLE) / (hi - lo))) END AS INTEGER) AS bin,
    count(*) AS stations
  FROM balance, geo WHERE final_balance IS NOT NULL GROUP BY 1),
bins AS (SELECT CAST(r.range AS INTEGER) AS bin, edge0, span FROM geo, range(0, {_BINS}) r WHERE n > 0)
SELECT b.bin, round(edge0 + b.bin * span / {_BINS}, 6) AS bin_lo,
       round(edge0 + (b.bin + 1) * span / {_BINS}, 6) AS bin_hi,
       CAST(COALESCE(c.stations, 0) AS BIGINT) AS stations
FROM bins b LEFT JOIN binned c ON b.bin = c.bin""",
    "surplus_deficit_top": f"""
(SELECT station_id, station_name, net_change FROM balance ORDER BY net_change DESC, station_id LIMIT {TOP_K})
UNION ALL
(SELECT station_id, station_name, net_change FROM balance ORDER BY net_change ASC, station_id DESC LIMIT {TOP_K})""",
    "below_initial_top": f"""
SELECT station_id, station_name, balance FROM adjusted WHERE balance < {q.INITIAL_BALANCE}
ORDER BY balance, station_id LIMIT {TOP_K}""",
    "above_initial_top": f"""
SELECT station_id, station_name, balance FROM adjusted WHERE balance > {q.INITIAL_BALANCE}
ORDER BY balance DESC, station_id LIMIT {TOP_K}""",
    "balance_labels": f"""
SELECT station_id, balance, CASE WHEN balance < {q.INITIAL_BALANCE} THEN 'below'
  WHEN balance > {q.INITIAL_BALANCE} THEN 'above' ELSE 'equal' END AS status FROM adjusted""",
    "table_status": """
SELECT 'station' AS name, count(*) AS "rows" FROM catalog
UNION ALL SELECT 'events_hourly', count(*) FROM deltas""",
    "run_summary": f"""
SELECT (SELECT count(*) FROM clean) AS trips, (SELECT count(*) FROM catalog) AS stations,
  (SELECT count(*) FROM deltas) AS hourly_events, count(*) AS analysed,
  count(*) FILTER (WHERE final_balance <= {LOW_THRESHOLD}) AS low_count, round(avg(final_balance), 6) AS mean_balance
FROM balance""",
    "upsert_stations": f"""
{_upsert_parts()},
old AS (SELECT station_id AS id, station_name AS name, {q.OLD_CAPACITY} AS capacity, {ACTIVE_RULE} AS is_active,
               TIMESTAMP '{q.OLD_CREATED}' AS created FROM ({_catalog("old_legs")})),
new AS (SELECT station_id AS id, station_name AS name FROM ({_catalog("new_legs")}))
SELECT COALESCE(n.id, o.id) AS id,
  CASE WHEN n.id IS NOT NULL THEN n.name ELSE o.name END AS name,
  CAST(CASE WHEN n.id IS NOT NULL THEN NULL ELSE o.capacity END AS INTEGER) AS capacity,
  CAST(CASE WHEN n.id IS NOT NULL THEN 1 ELSE o.is_active END AS INTEGER) AS is_active,
  strftime(COALESCE(o.created, TIMESTAMP '{q.NEW_CREATED}'), '%Y-%m-%d %H:%M:%S') AS created_at_utc
FROM old o FULL OUTER JOIN new n ON o.id = n.id""",
    "upsert_deltas": f"""
{_upsert_parts()},
old AS ({_deltas("old_legs")}),
new AS ({_deltas("new_legs")})
SELECT hour, station_id, delta_total FROM new
UNION ALL
SELECT o.hour, o.station_id, o.delta_total FROM old o
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.hour = o.hour AND n.station_id = o.station_id)""",
    "csv_inferred_shape": 'SELECT count(*) AS "rows", 13 AS "columns" FROM events',
    "csv_round_trip": "SELECT hour, station_id, delta_total FROM deltas",
    "stream_hourly_deltas": "SELECT hour, station_id, delta_total FROM deltas",
    "stream_balance": """
SELECT station_id, hour, CAST(sum(delta_total) OVER (PARTITION BY station_id ORDER BY hour
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS balance FROM deltas""",
}

SHIP_SELECTS: dict[str, str] = {
    "shipment_nation_balance": f"""
SELECT 'N' || n.n_nationkey AS station_id, n.n_name AS station_name,
  CAST(COALESCE(t.net, 0) AS BIGINT) AS net_change,
  CAST({q.INITIAL_BALANCE} + COALESCE(t.net, 0) AS BIGINT) AS final_balance
FROM nation n LEFT JOIN (SELECT station_id, sum(net) AS net FROM sdaily GROUP BY 1) t
  ON 'N' || n.n_nationkey = t.station_id""",
    "shipment_daily_flow": "SELECT date, station_id, net FROM sdaily",
    "shipment_balance": f"""
SELECT date, station_id, net,
  CAST({q.INITIAL_BALANCE} + sum(net) OVER (PARTITION BY station_id ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS balance
FROM sdaily""",
}

SELECTS |= {
    "source_inventory": "SELECT 'events.parquet' AS file_name, count(*) AS \"rows\" FROM events",
    "batch_job": f"""
SELECT (SELECT count(*) FROM clean) AS trips, count(*) AS stations, (SELECT count(*) FROM deltas) AS hourly_events,
  count(*) AS analysed, count(*) FILTER (WHERE b <= {LOW_THRESHOLD}) AS low_count, round(avg(b), 6) AS mean_balance
FROM (SELECT {q.INITIAL_BALANCE} + COALESCE(t.net_change, 0) AS b FROM catalog c LEFT JOIN totals t USING (station_id))""",
    "table_upsert_twice": SELECTS["upsert_deltas"],
    "table_upsert_stations_twice": SELECTS["upsert_stations"],
    "table_active_stations": SELECTS["active_stations"] + " ORDER BY name, id",
    "table_station_lookup": SELECTS["station_lookup"],
    "table_station_range": SELECTS["station_events_range"] + " ORDER BY hour",
    "table_hourly_events": f"SELECT hour, station_id, delta_total AS delta FROM deltas WHERE hour >= '{q.RANGE_START}' AND hour <= '{q.RANGE_END}'",
    "table_balances_as_of": SELECTS["balances_as_of"],
    "table_balances_at_step": SELECTS["balances_adjusted"],
    "table_stored_status": SELECTS["table_status"],
    "table_orphans": SELECTS["orphan_station_events"],
    "table_balance_carry_over": SELECTS["balance_carry_over"],
    "table_balances_as_of_late": SELECTS["balances_as_of"],
    "running_balance_by_day": SELECTS["running_balance"],
    "balance_stats_by_selection": SELECTS["balance_stats"],
    "table_add_twice": SELECTS["hourly_deltas"],
    "stream_csv_deltas": SELECTS["hourly_deltas"],
    "stream_windowed_deltas": SELECTS["hourly_deltas"],
    "table_delete_cascade": f"SELECT hour, station_id, delta_total FROM deltas WHERE station_id NOT IN (SELECT id FROM stations WHERE id LIKE '%{q.DELETED_SUFFIX}')",
    "table_delete_cascade_stations": f"SELECT id, name, capacity, is_active FROM stations WHERE id NOT LIKE '%{q.DELETED_SUFFIX}'",
    "csv_quarantine": f"SELECT ride_id FROM trips WHERE CAST(substr(ride_id, 2) AS BIGINT) % {q.MALFORMED_EVERY} = {q.MALFORMED_AT}",
    "daily_top_all": f"""
SELECT date, station_id, difference, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY difference DESC, station_id) AS rank FROM daily)
WHERE rank <= {q.DAILY_TOP_K}""",
    "stream_balance_open": f"""
, last_part AS (SELECT * FROM clean WHERE COALESCE(day(started_at), 0) % {q.STREAM_FILES} = {q.STREAM_FILES - 1}),
last_legs AS ({_legs("last_part")}),
opened AS (SELECT DISTINCT {HOUR} AS hour, station_id FROM last_legs),
sums AS (SELECT station_id, hour, sum(delta_total) OVER (PARTITION BY station_id ORDER BY hour
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance FROM deltas)
SELECT station_id, hour, CAST(balance AS BIGINT) AS balance FROM sums s
WHERE substr(hour, 1, 10) IN (SELECT substr(hour, 1, 10) FROM opened)
  AND EXISTS (SELECT 1 FROM opened o WHERE o.station_id = s.station_id AND o.hour <= s.hour)""",
}


def _compose(base: str, select: str) -> str:
    return base.rstrip() + "\n" + select.strip()


ORACLES: dict[str, str] = {name: _compose(BASE, sql) for name, sql in SELECTS.items()}
ORACLES.update({name: _compose(SHIP, sql) for name, sql in SHIP_SELECTS.items()})
