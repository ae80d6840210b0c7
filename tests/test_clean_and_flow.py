"""Literal unit cases of the cleaning, leg and delta rules (one test per decision)."""

from pyspark.sql import functions as F

from ebbflow import operators as op
from tests.helpers import rows, trip, trips_df


def deltas_of(spark, trips):
    return rows(op.hourly_deltas(op.clean_trips(trips_df(spark, trips))), "hour", "station_id", "delta_total")


def test_blank_start_id_keeps_arrival_leg(spark):
    got = deltas_of(spark, [trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:20:00", "   ", "S2")])
    assert got == [("2024-01-01 10:00:00", "S2", 1)]


def test_both_blank_dropped(spark):
    assert deltas_of(spark, [trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:20:00", "", "")]) == []


def test_end_before_start_dropped(spark):
    assert deltas_of(spark, [trip("r1", "2024-01-01 10:00:00", "2024-01-01 09:59:00", "S1", "S2")]) == []


def test_null_end_dropped(spark):
    assert deltas_of(spark, [trip("r1", "2024-01-01 10:00:00", None, "S1", "S2")]) == []


def test_end_equals_start_same_station_nets_zero(spark):
    got = deltas_of(spark, [trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:00:00", "S1", "S1")])
    assert got == [("2024-01-01 10:00:00", "S1", 0)]


def test_cross_hour_gives_two_keys(spark):
    got = deltas_of(spark, [trip("r1", "2024-01-01 10:59:00", "2024-01-01 11:01:00", "S1", "S2")])
    assert got == [("2024-01-01 10:00:00", "S1", -1), ("2024-01-01 11:00:00", "S2", 1)]


def test_padded_ids_are_trimmed(spark):
    got = deltas_of(spark, [trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:10:00", " S1 ", "S1")])
    assert got == [("2024-01-01 10:00:00", "S1", 0)]


def test_tab_is_not_trimmed(spark):
    # Spark's trim strips spaces only; a tab-only id is a (strange) station
    got = deltas_of(spark, [trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "\t", "S1")])
    assert ("2024-01-01 10:00:00", "\t", -1) in got


def test_null_name_in_deltas_not_in_catalog(spark):
    t = trips_df(spark, [trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "S5", "S6", None, "Six")])
    cleaned = op.clean_trips(t)
    assert rows(op.station_catalog(cleaned)) == [("S6", "Six")]
    assert {r[1] for r in rows(op.hourly_deltas(cleaned))} == {"S5", "S6"}


def test_two_names_pick_smallest(spark):
    t = trips_df(
        spark,
        [
            trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "S1", None, "B"),
            trip("r2", "2024-01-01 11:00:00", "2024-01-01 11:10:00", "S1", None, "A"),
        ],
    )
    assert rows(op.station_catalog(op.clean_trips(t))) == [("S1", "A")]


def test_name_pairs_keep_both_names(spark):
    t = trips_df(
        spark,
        [
            trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:10:00", " S1", None, "B "),
            trip("r2", "2024-01-01 11:00:00", "2024-01-01 11:10:00", "S1", None, "A"),
        ],
    )
    assert rows(op.station_name_pairs(op.normalise_trips(t))) == [("S1", "A"), ("S1", "B")]


def test_by_class_sums_to_total(spark):
    t = trips_df(
        spark,
        [
            trip("r1", "2024-01-01 10:00:00", "2024-01-01 10:10:00", "S1", "S2", kind="electric_bike"),
            trip("r2", "2024-01-01 10:05:00", "2024-01-01 10:15:00", "S1", "S2", kind="classic_bike"),
            trip("r3", "2024-01-01 10:05:00", "2024-01-01 10:15:00", "S1", "S3", kind=None),
        ],
    )
    d = op.hourly_deltas(op.clean_trips(t), by_class=True)
    got = {r["station_id"]: (r["delta_total"], r["delta_ebike"], r["delta_other"]) for r in d.collect()}
    assert got == {"S1": (-3, -1, -2), "S2": (2, 1, 1), "S3": (1, 0, 1)}


def test_string_timestamps_bad_values_become_null(spark):
    df = spark.createDataFrame(
        [("r1", "2024-01-01 10:00:00", "not a time", "S1", "S2"), ("r2", "2024-01-01 10:00:00", "2024-01-01 10:30:00.5", "S1", "S2")],
        "ride_id string, started_at string, ended_at string, start_station_id string, end_station_id string",
    )
    got = op.clean_trips(df).select("ride_id").collect()
    assert [r[0] for r in got] == ["r2"]


def test_dst_spring_gap_and_autumn_switch(spark):
    from ebbflow.config import configure

    old = spark.conf.get("spark.sql.session.timeZone")
    configure(spark, "America/Chicago")
    try:
        df = spark.createDataFrame(
            [
                ("r1", "2024-03-10 02:30:00", "2024-03-10 02:40:00", "S1", "S2"),
                ("r2", "2024-11-03 01:30:00", "2024-11-03 01:10:00", "S1", "S2"),
            ],
            "ride_id string, started_at string, ended_at string, start_station_id string, end_station_id string",
        )
        got = rows(op.hourly_deltas(op.clean_trips(df)), "hour", "station_id", "delta_total")
        # 02:30 does not exist on the spring-forward day and reads as 03:30; the autumn row looks reversed
        assert got == [("2024-03-10 03:00:00", "S1", -1), ("2024-03-10 03:00:00", "S2", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_empty_input(spark):
    d = op.hourly_deltas(op.clean_trips(trips_df(spark, [])))
    assert d.count() == 0


def test_daily_flow_sign_and_null_station(spark):
    t = trips_df(
        spark,
        [
            trip("r1", "2024-01-01 23:50:00", "2024-01-02 00:10:00", "S1", "S2"),
            trip("r2", "2024-01-01 10:00:00", "2024-01-01 10:10:00", None, "S2"),
        ],
    )
    d = op.daily_net_flow(op.clean_trips(t)).select(F.col("date").cast("string"), "station_id", "difference")
    assert rows(d) == [("2024-01-01", "S1", 1), ("2024-01-01", "S2", -1), ("2024-01-02", "S2", -1)]


def test_empty_input_summary_of_zeros(spark):
    clean = op.clean_trips(trips_df(spark, []))
    flow = op.flow_with_counts(clean)
    s = op.flow_run_summary(flow).collect()[0]
    assert (s["trips"], s["stations"], s["hourly_events"], s["analysed"], s["low_count"]) == (0, 0, 0, 0, 0)
    assert s["mean_balance"] is None
    r = op.rebalancing_summary(op.balance_from_trips(clean).withColumnRenamed("balance", "final_balance")).collect()[0]
    assert (r["low_count"], r["high_count"], r["deficit"], r["surplus"], r["net"]) == (0, 0, 0, 0, 0)
    assert op.balance_histogram(op.balance_from_trips(clean), "balance").count() == 0
