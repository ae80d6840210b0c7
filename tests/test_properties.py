"""Property tests on generated trips: Spark results equal a plain-Python model of the same rules."""

import datetime as dt
from collections import Counter, defaultdict

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ebbflow import operators as op
from tests.helpers import trips_df

BASE = dt.datetime(2024, 1, 1)
IDS = st.sampled_from([None, "", "   ", " S1", "S1", "S2 ", "S3", "S10"])
NAMES = st.sampled_from([None, "", "Alpha", "Beta", " Gamma "])
KINDS = st.sampled_from([None, "electric_bike", "classic_bike", "  "])
MINUTES = st.integers(min_value=0, max_value=3 * 24 * 60)
SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


@st.composite
def trip_rows(draw):
    n = draw(st.integers(min_value=0, max_value=25))
    rows = []
    for i in range(n):
        start = BASE + dt.timedelta(minutes=draw(MINUTES), seconds=draw(st.integers(0, 59)))
        dur = draw(st.one_of(st.none(), st.integers(min_value=-30, max_value=200)))
        rows.append(
            {
                "ride_id": f"r{i}",
                "rideable_type": draw(KINDS),
                "started_at": start,
                "ended_at": None if dur is None else start + dt.timedelta(minutes=dur),
                "start_station_id": draw(IDS),
                "end_station_id": draw(IDS),
                "start_station_name": draw(NAMES),
                "end_station_name": draw(NAMES),
            }
        )
    return rows


def _norm(v):
    if v is None:
        return None
    v = v.strip(" ")
    return v or None


def model_deltas(rows):
    """hour → station → (total, ebike, other) with the documented cleaning rules."""
    out = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        s, e, kind = _norm(r["start_station_id"]), _norm(r["end_station_id"]), _norm(r["rideable_type"])
        a, b = r["started_at"], r["ended_at"]
        if a is None or b is None or b < a or (s is None and e is None):
            continue
        for station, ts, d in ((s, a, -1), (e, b, 1)):
            if station is None:
                continue
            key = (ts.strftime("%Y-%m-%d %H:00:00"), station)
            out[key][0] += d
            out[key][1 if kind == "electric_bike" else 2] += d
    return {k: tuple(v) for k, v in out.items()}


def model_catalog(rows):
    names = defaultdict(set)
    for r in rows:
        a, b = r["started_at"], r["ended_at"]
        s, e = _norm(r["start_station_id"]), _norm(r["end_station_id"])
        if a is None or b is None or b < a or (s is None and e is None):
            continue
        for sid, name in ((s, _norm(r["start_station_name"])), (e, _norm(r["end_station_name"]))):
            if sid is not None and name is not None:
                names[sid].add(name)
    return {k: min(v) for k, v in names.items()}


@SETTINGS
@given(trip_rows())
def test_hourly_deltas_match_model(spark, rows):
    d = op.hourly_deltas(op.clean_trips(trips_df(spark, rows)), by_class=True)
    got = {(r["hour"], r["station_id"]): (r["delta_total"], r["delta_ebike"], r["delta_other"]) for r in d.collect()}
    assert got == model_deltas(rows)


@SETTINGS
@given(trip_rows())
def test_catalog_and_fused_balance_match_model(spark, rows):
    clean = op.clean_trips(trips_df(spark, rows))
    cat = {r["station_id"]: r["station_name"] for r in op.station_catalog(clean).collect()}
    assert cat == model_catalog(rows)
    totals = Counter()
    for (_, station), (total, _, _) in model_deltas(rows).items():
        totals[station] += total
    fused = {r["station_id"]: (r["station_name"], r["balance"]) for r in op.balance_from_trips(clean).collect()}
    assert fused == {sid: (name, 20 + totals[sid]) for sid, name in cat.items()}


@SETTINGS
@given(st.lists(st.integers(min_value=-500, max_value=500), min_size=1, max_size=40))
def test_histogram_matches_numpy(spark, values):
    b = spark.createDataFrame([(f"S{i}", v) for i, v in enumerate(values)], "station_id string, final_balance long")
    got = sorted((r["bin"], r["stations"]) for r in op.balance_histogram(b).collect())
    counts, _ = np.histogram(values, bins=50)
    assert [c for _, c in got] == list(counts)


@SETTINGS
@given(st.sets(st.integers(min_value=0, max_value=24 * 20 - 1), min_size=1, max_size=60), st.integers(0, 80))
def test_hour_index_and_step(spark, hour_offsets, steps):
    hours = sorted((BASE + dt.timedelta(hours=h)).strftime("%Y-%m-%d %H:00:00") for h in hour_offsets)
    d = spark.createDataFrame([(h, "S1", 1) for h in hours], "hour string, station_id string, delta_total long")
    assert sorted((r["hour_index"], r["hour"]) for r in op.hour_index(d).collect()) == list(enumerate(hours))
    step = op.hour_at_step(d, 16, steps).collect()
    assert step[0]["hour"] == hours[min(16 + steps, len(hours) - 1)]


@SETTINGS
@given(trip_rows(), trip_rows())
def test_merge_replace_idempotent(spark, old_rows, new_rows):
    old = op.hourly_deltas(op.clean_trips(trips_df(spark, old_rows)))
    new = op.hourly_deltas(op.clean_trips(trips_df(spark, new_rows)))
    once = op.merge_deltas(old, new)
    twice = op.merge_deltas(once, new)
    as_set = lambda df: sorted(tuple(r) for r in df.select("hour", "station_id", "delta_total").collect())
    assert as_set(once) == as_set(twice)
    expected = dict(((h, s), v[0]) for (h, s), v in model_deltas(old_rows).items())
    expected.update({(h, s): v[0] for (h, s), v in model_deltas(new_rows).items()})
    assert {(h, s): v for h, s, v in as_set(once)} == expected
