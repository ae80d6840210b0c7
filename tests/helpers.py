import datetime as dt

from ebbflow.schemas import TRIP_SCHEMA


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def trips_df(spark, rows):
    """rows: dicts with any of the trip columns; the rest are NULL."""
    full = [tuple(r.get(f.name) for f in TRIP_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(full, TRIP_SCHEMA)


def trip(rid, start, end, s_id=None, e_id=None, s_name=None, e_name=None, kind="classic_bike"):
    return {
        "ride_id": rid,
        "rideable_type": kind,
        "started_at": ts(start) if start else None,
        "ended_at": ts(end) if end else None,
        "start_station_id": s_id,
        "end_station_id": e_id,
        "start_station_name": s_name,
        "end_station_name": e_name,
    }


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
