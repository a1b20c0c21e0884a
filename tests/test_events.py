"""Bus and rail stop events with literal cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tramline.operators import events, filters, joins
from tramline.plans import stop_events as se

POSITION = (
    "route_id string, trip_id string, stop_id string, stop_sequence long, direction_id int, start_time string, service_date date, "
    "vehicle_id string, vehicle_label string, latitude double, longitude double, current_status string, vehicle_timestamp timestamp"
)


def position(trip, stop, seq, status, clock):
    h, m = map(int, clock.split(":"))
    return (
        "1", trip, stop, seq, 0, "08:45:00", dt.date(2024, 6, 1), "y1", "101", 42.0 + seq, -71.0, status,
        dt.datetime(2024, 6, 1, h, m, tzinfo=dt.timezone.utc),
    )


def test_two_stops_make_two_events(spark):
    df = spark.createDataFrame(
        [
            position("101", "1", 1, "IN_TRANSIT_TO", "08:45"),
            position("101", "1", 1, "STOPPED_AT", "08:47"),
            position("101", "2", 2, "IN_TRANSIT_TO", "08:55"),
            position("101", "2", 2, "STOPPED_AT", "08:57"),
            position("101", "1", 1, "IN_TRANSIT_TO", "08:40"),
        ],
        POSITION,
    )
    found = events.positions_to_events(df).orderBy("gtfs_stop_sequence").collect()
    assert [(r.gtfs_stop_sequence, r.gtfs_first_in_transit_dt.minute, r.gtfs_arrival_dt.minute, r.gtfs_departure_dt.minute, r.stop_count, r.latitude) for r in found] == [
        (1, 40, 47, 47, 2, 43.0), (2, 55, 57, 57, 2, 44.0),
    ]
    assert found[0].start_time == 31500


def test_a_record_before_a_lower_sequence_is_dropped(spark):
    df = spark.createDataFrame(
        [position("101", "9", 9, "STOPPED_AT", "08:00"), position("101", "1", 1, "STOPPED_AT", "09:00"), position("101", "2", 2, "STOPPED_AT", "09:10")],
        POSITION,
    )
    assert [r.gtfs_stop_sequence for r in events.positions_to_events(df).orderBy("gtfs_stop_sequence").collect()] == [1, 2]


def test_no_positions_no_events_same_columns(spark):
    empty = spark.createDataFrame([], POSITION)
    found = events.positions_to_events(empty)
    assert found.count() == 0
    assert {"gtfs_arrival_dt", "gtfs_departure_dt", "stop_count", "start_dt"} <= set(found.columns)


def test_bus_filter_keeps_complete_rows_of_the_day(spark):
    df = spark.createDataFrame(
        [
            ("39", "t", "s", "v", 1, "05:00:00", "20240601", "INCOMING_AT"),
            ("39", "t", None, "v", 1, "05:00:00", "20240601", "STOPPED_AT"),
            ("39", "t", "s", "v", 1, "05:00:00", "20240602", "STOPPED_AT"),
            ("Red", "t", "s", "v", 1, "05:00:00", "20240601", "STOPPED_AT"),
        ],
        "route_id string, trip_id string, stop_id string, vehicle_id string, timestamp long, start_time string, start_date string, current_status string",
    )
    routes = spark.createDataFrame([("39",)], "route_id string")
    assert [r.current_status for r in filters.bus_positions(df, routes, "20240601").collect()] == ["IN_TRANSIT_TO"]


T = 2_000_000_000


def event(seq, ts, arrived, departed, last):
    return ("id", ts, "20240101", "r", "t", "v", seq, 0, "08:00:00", True, "s", arrived, departed, last)


EXISTING = [event(2, T + 1, T, T, T), event(3, T + 2, T + 1, None, T + 1)]


@pytest.mark.parametrize(
    "existing,new,expected",
    [
        (EXISTING, event(3, T + 2, T + 1, None, T + 1), [(2, T + 1, T, T), (3, T + 2, T + 1, None)]),
        (EXISTING, event(3, T + 3, T + 2, None, T + 2), [(2, T + 1, T, T), (3, T + 2, T + 1, None)]),
        (EXISTING, event(4, T + 3, T + 2, None, T + 2), [(2, T + 1, T, T), (3, T + 3, T + 1, T + 1), (4, T + 3, T + 2, None)]),
        ([event(2, 10**9, 10**9, 10**9, 10**9)], event(4, T + 3, T + 2, None, T + 2), [(4, T + 3, T + 2, None)]),
        (EXISTING, event(50, T + 3, T + 2, None, T + 2), [(2, T + 1, T, T), (3, T + 3, T + 1, T + 1), (50, T + 3, T + 2, None)]),
        (
            [event(2, T + 1, None, None, T), event(3, T + 2, None, None, T + 1)],
            event(3, T + 3, T + 2, None, T + 2),
            [(2, T + 3, None, T), (3, T + 2, T + 2, None)],
        ),
    ],
    ids=["old-only", "same-sequence-newer", "new-sequence", "outdated", "non-sequential", "null-times"],
)
def test_stop_event_transitions(spark, existing, new, expected):
    state = spark.createDataFrame(existing, se.STATE)
    fresh = spark.createDataFrame([new], se.STATE)
    got = se.update_stop_events(state, fresh, T + 3)
    assert sorted((r.stop_sequence, r.timestamp, r.arrived, r.departed) for r in got.collect()) == expected


def test_unnest_positions(spark):
    doc = (
        "named_struct('id', 'e', 'vehicle', named_struct('trip', named_struct('trip_id', {trip}, 'route_id', 'r', 'direction_id', 0, 'start_time', '08:00:00', "
        "'start_date', '20240101', 'revenue', true), 'vehicle', named_struct('id', 'v', 'label', 'l'), 'current_stop_sequence', {seq}, 'stop_id', 's', "
        "'timestamp', {ts}, 'current_status', '{status}'))"
    )
    stand = doc.format(trip="'t'", seq="bigint(3)", ts="bigint(100)", status="STOPPED_AT")
    move = doc.format(trip="'u'", seq="bigint(4)", ts="bigint(110)", status="IN_TRANSIT_TO")
    none = doc.format(trip="'w'", seq="bigint(null)", ts="bigint(120)", status="STOPPED_AT")
    found = se.unnest_positions(spark.sql(f"select array({stand}, {move}, {none}) entity"))
    assert sorted((r.id, r.timestamp, r.arrived) for r in found.collect()) == [
        ("20240101-r-t-v-3", 100, 100), ("20240101-r-u-v-4", 110, None),
    ]


def test_vehicle_match_prefers_the_equal_label(spark):
    planned = spark.createDataFrame(
        [("a", "p1", "7"), ("a", "p2", None), ("b", "p3", None), ("c", "p4", "9"), ("e", "p5", "1")],
        "trip_id string, tm_pullout_id string, vehicle_label string",
    )
    seen = spark.createDataFrame([("a", "7"), ("a", "8"), ("b", "5"), ("c", "4"), ("d", "3")], "trip_id string, vehicle_label string")
    got = {tuple(r) for r in joins.trip_vehicle_match(planned, seen).collect()}
    # "c" has a vehicle of its own, so another one is not its match
    assert got == {("a", "p1", "7", "7"), ("a", "p2", None, "8"), ("b", "p3", None, "5"), ("d", None, None, "3")}
