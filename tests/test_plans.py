"""Whole jobs on small frames made from the feeds' schemas."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tramline.plans import alerts, archive, bus, exports, extracts, ingest, rail
from tramline.session import cut_lineage, scratch_path
from tramline.sources import event_bus, feeds
from tramline.sources.schedules import SCHEDULE_TABLES, read_csv_table, table_schema
from tramline.sources.tables import conform


def utc(day, h, m=0, s=0):
    return dt.datetime(2025, 1, day, h, m, s, tzinfo=dt.timezone.utc)


GTFS = (
    "service_date date, trip_id string, stop_id string, route_id string, gtfs_stop_sequence long, plan_stop_departure_dt timestamp, block_id string, "
    "checkpoint_id string, service_id string, route_pattern_id string, route_pattern_typicality long, direction_id int, direction string, "
    "direction_destination string, plan_stop_count long, plan_start_time long, plan_start_dt timestamp"
)
TM = (
    "service_date date, trip_id string, stop_id string, route_id string, tm_stop_sequence long, PULLOUT_ID string, tm_stop_departure_dt timestamp, "
    "vehicle_label string, pattern_id long, timepoint_abbr string"
)
DAY = dt.date(2025, 1, 1)


def gtfs_row(seq, stop, at, trip="1"):
    return (DAY, trip, stop, "a", seq, at, "b", None, "s", "rp", 1, 0, "Out", "There", 3, 0, utc(1, 1))


def tm_row(seq, stop, at, pullout="0", label="v1"):
    return (DAY, "1", stop, "a", seq, pullout, at, label, 5, "tp")


@pytest.mark.parametrize(
    "gtfs",
    [
        [(1, "a", utc(1, 1)), (2, "b", utc(1, 2)), (3, "c", utc(1, 3)), (4, "d", utc(1, 4))],
        [(1, "a", utc(1, 1)), (2, "b", utc(1, 2)), (4, "d", utc(1, 4)), (3, "c", utc(1, 3))],
        [(1, "z", utc(1, 1)), (2, "b", utc(1, 2)), (3, "c", utc(1, 3))],
        [(1, "a", utc(1, 1)), (2, "z", utc(1, 2, 30)), (3, "c", utc(1, 3))],
    ],
    ids=["in-order", "out-of-order", "startpoint-disagreement", "midpoint-disagreement"],
)
def test_combined_schedule_sequences(spark, gtfs):
    tm = [tm_row(1, "a", utc(1, 1)), tm_row(2, "b", utc(1, 2)), tm_row(3, "c", utc(1, 3))]
    got = bus.combined_schedule(spark.createDataFrame([gtfs_row(*g) for g in gtfs], GTFS), spark.createDataFrame(tm, TM))
    rows = sorted(got.collect(), key=lambda r: r.stop_sequence)
    own = [r.gtfs_stop_sequence for r in rows if r.gtfs_stop_sequence is not None]
    assert own == sorted(own)
    assert [r.stop_sequence for r in rows] == list(range(1, len(rows) + 1))
    assert rows[0].point_type == "start" and rows[-1].point_type == "end"
    assert all(r.block_id == "b" and r.tm_pullout_id == "0" for r in rows)


def test_combined_schedule_does_not_double_rows_of_trip_variants(spark):
    gtfs = [gtfs_row(i + 1, s, utc(1, i + 1)) for i, s in enumerate("abc")]
    tm = [tm_row(i + 1, s, at, pullout=p) for p, off in (("1", -60), ("2", 0), ("3", 60)) for i, s in enumerate("abc") for at in [utc(1, i + 1) + dt.timedelta(seconds=off)]]
    got = bus.combined_schedule(spark.createDataFrame(gtfs, GTFS), spark.createDataFrame(tm, TM))
    joined = got.filter("schedule_joined = 'JOIN'").collect()
    # the planned departure is known to the trip, so each of its pullouts joins, once per stop
    assert sorted((r.stop_id, r.tm_pullout_id) for r in joined) == [(s, p) for s in "abc" for p in "123"]
    assert got.count() == 9


# columns that the rows below give; the tables' other columns are null
WRITTEN = {
    "route_patterns": "route_pattern_id string, route_id string, direction_id long, route_pattern_name string, route_pattern_time_desc string, route_pattern_typicality long, route_pattern_sort_order long, representative_trip_id string",
    "routes": "route_id string, agency_id long, route_short_name string, route_long_name string, route_desc string, route_type long, route_sort_order long, route_fare_class string, line_id string",
    "stops": "stop_id string, stop_code string, stop_name string, stop_desc string, platform_code string, platform_name string, stop_lat double, stop_lon double, parent_station string",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence long, checkpoint_id string",
    "trips": "route_id string, service_id string, trip_id string, trip_headsign string, direction_id long, block_id string, shape_id string, route_pattern_id string",
}


def schedule_tables(spark):
    data = {
        "calendar": [("s", *([1] * 7), 20250101, 20251231)],
        "calendar_dates": [],
        "directions": [("a", 0, "Outbound", "Harbor")],
        "route_patterns": [("rp", "a", 0, "n", None, 1, 1, "1")],
        "routes": [("a", 1, "a", "Route a", None, 3, 1, None, None), ("Red", 1, None, "Red", None, 1, 1, None, None)],
        "stops": [(s, None, f"Stop {s}", None, None, None, 42.0, -71.0, None) for s in "abc"],
        "stop_times": [("1", f"08:{i}0:00", f"08:{i}0:00", s, i + 1, None) for i, s in enumerate("abc")],
        "trips": [("a", "s", "1", None, 0, "b", None, "rp")],
    }
    out = {}
    for name, rows in data.items():
        df = spark.createDataFrame(rows, WRITTEN.get(name) or table_schema(name))
        out[name] = conform(df, table_schema(name)).withColumns({"gtfs_active_date": F.lit(20250101).cast("long"), "gtfs_end_date": F.lit(20251231).cast("long")})
    return out


CROSSINGS = (
    "STOP_CROSSING_ID long, CALENDAR_ID long, ROUTE_ID long, GEO_NODE_ID long, TRIP_ID long, VEHICLE_ID long, TIME_POINT_ID long, WAIVER_ID long, PULLOUT_ID long, "
    "PATTERN_GEO_NODE_SEQ long, SCHEDULED_TIME long, ACT_ARRIVAL_TIME long, ACT_DEPARTURE_TIME long"
)


def test_bus_day_end_to_end(spark):
    eight = 8 * 3600
    crossings = spark.createDataFrame(
        [
            (10 + i, 120250106, 1, i, 1, 9 if i else None, 1, 1 if i == 2 else None, 77, i + 1, eight + i * 600, eight + i * 600 + 30, eight + i * 600 + 40)
            for i in range(3)
        ],
        CROSSINGS,
    )
    dims = {
        "trip": spark.createDataFrame([(1, 1, 5)], "TRIP_ID long, TRIP_SERIAL_NUMBER long, PATTERN_ID long"),
        "geo_node": spark.createDataFrame([(i, s) for i, s in enumerate("abc")], "GEO_NODE_ID long, GEO_NODE_ABBR string"),
        "route": spark.createDataFrame([(1, "00a")], "ROUTE_ID long, ROUTE_ABBR string"),
        "vehicle": spark.createDataFrame([(9, "1900")], "VEHICLE_ID long, PROPERTY_TAG string"),
        "time_point": spark.createDataFrame([(1, "tp", "Time point")], "TIME_POINT_ID long, TIME_POINT_ABBR string, TIME_PT_NAME string"),
        "waiver": spark.createDataFrame([(1, "LATE - someone", 1)], "WAIVER_ID long, REMARK string, MISSED_ALLOWED_FLAG long"),
    }
    # 08:00 in Boston is 13:00 UTC
    base = int(utc(6, 13).timestamp())
    seen = []
    for i, stop in enumerate("abc"):
        seen.append(("a", "1-OL1", stop, i + 1, 0, "08:00:00", "20250106", "y9", "1900", 42.0, -71.0, "IN_TRANSIT_TO", base + i * 600))
        seen.append(("a", "1-OL1", stop, i + 1, 0, "08:00:00", "20250106", "y9", "1900", 42.0, -71.0, "STOPPED_AT", base + i * 600 + 20))
    positions = spark.createDataFrame(
        seen,
        "route_id string, trip_id string, stop_id string, stop_sequence long, direction_id int, start_time string, start_date string, vehicle_id string, "
        "vehicle_label string, latitude double, longitude double, current_status string, timestamp long",
    )
    pieces = bus.static_work_pieces(
        spark.createDataFrame([(1, 2, 3, eight - 100, eight + 9000, 1), (2, 2, 3, eight + 9000, eight + 20000, 1)], "WORK_PIECE_ID long, BLOCK_ID long, RUN_ID long, BEGIN_TIME long, END_TIME long, TIME_TABLE_VERSION_ID long"),
        spark.createDataFrame([(2, "B2", 1)], "BLOCK_ID long, BLOCK_ABBR string, TIME_TABLE_VERSION_ID long"),
        spark.createDataFrame([(3, "R3", 1)], "RUN_ID long, RUN_DESIGNATOR string, TIME_TABLE_VERSION_ID long"),
        spark.createDataFrame([(1, 2, 1, eight + 1200, 1)], "TRIP_ID long, BLOCK_ID long, TRIP_SERIAL_NUMBER long, TRIP_END_TIME long, TIME_TABLE_VERSION_ID long"),
    )
    work = bus.operator_assignment(
        spark.createDataFrame([(1, 120250106, 4, 3, 9, eight, None)], "WORK_PIECE_ID long, CALENDAR_ID long, CURRENT_OPERATOR_ID long, RUN_ID long, CURRENT_VEHICLE_ID long, ACTUAL_LOGON_TIME long, ACTUAL_LOGOFF_TIME long"),
        spark.createDataFrame([(4, 4444)], "OPERATOR_ID long, ONBOARD_LOGON_ID long"),
        dims["vehicle"],
        pieces,
    )
    assert work.count() == 1
    ids = bus.public_operator_ids(work, "s")
    operators = cut_lineage(work.join(ids, ["service_date", "tm_trip_id"], "left"))
    day = bus.bus_performance(20250106, schedule_tables(spark), positions, crossings, dims, operators)
    rows = sorted(day.collect(), key=lambda r: r.stop_sequence)
    assert [r.stop_id for r in rows] == ["a", "b", "c"]
    assert all(r.schedule_joined == "JOIN" and r.vehicle_label == "1900" and r.is_full_trip for r in rows)
    assert all(r.route_id == "a" and r.trip_id_gtfs == "1-OL1" for r in rows)
    # first stop departs by the feed; others at the earlier of feed and log; arrival is the later, at most the departure
    assert [r.stop_departure_seconds for r in rows] == [eight + 20, eight + 620, eight + 1220]
    assert [r.plan_stop_departure_seconds for r in rows] == [eight, eight + 600, eight + 1200]
    assert [r.travel_time_seconds for r in rows] == [None, 600, 600]
    assert rows[2].waiver_remark == "LATE" and rows[1].previous_stop_id == "a"
    assert all(str(r.public_operator_id).startswith("20250106") for r in rows)


def rail_static(spark):
    feeds_ = spark.createDataFrame([(7, 20240101, 20251231, 20240101, 1)], "static_version_key long, feed_start_date long, feed_end_date long, feed_active_date long, created_on long")
    stops = spark.createDataFrame([(7, "70086", "place-smmnl", "S"), (7, "70088", "place-fldcr", "F"), (7, "70090", "place-shmnl", "H")], "static_version_key long, stop_id string, parent_station string, stop_name string")
    return feeds_, stops


def test_rail_day_end_to_end(spark):
    feed_info, stops = rail_static(spark)
    base = int(dt.datetime(2024, 6, 3, 12, tzinfo=dt.timezone.utc).timestamp())
    schema = (
        "current_status string, current_stop_sequence long, stop_id string, vehicle_timestamp long, direction_id long, route_id string, start_date string, start_time string, "
        "revenue boolean, vehicle_id string, trip_id string, vehicle_label string, vehicle_consist array<struct<label:string>>, multi_carriage_details array<struct<label:string>>"
    )
    rows = []
    for n, trip in enumerate(("t1", "t2")):
        for i, stop in enumerate(("70086", "70088", "70090")):
            at = base + n * 300 + i * 100
            common = (0, "Red", "20240603" if n else None, "08:00:00" if n == 0 else None, None, f"v{n}", trip, f"18{n}", None, [("1800",), ("1801",)])
            rows.append(("IN_TRANSIT_TO", i + 1, stop, at, *common))
            rows.append(("STOPPED_AT", i + 1, stop, at + 60, *common))
    vp = rail.position_events(spark.createDataFrame(rows, schema), ["Red"], feed_info, stops)
    tu = rail.prediction_events(
        spark.createDataFrame(
            [("70090", base + 262, 0, "Red", "20240603", None, "v0", "t1", base + 200, base), ("70090", base + 265, 0, "Red", "20240603", None, "v0", "t1", base + 240, base), ("70090", base + 900, 0, "Red", "20240603", None, "v0", "t1", base + 250, base)],
            "stop_id string, tu_stop_timestamp long, direction_id long, route_id string, start_date string, start_time long, vehicle_id string, trip_id string, timestamp long, feed_timestamp long",
        ).withColumn("service_date", F.col("start_date").cast("long")).drop("start_date"),
        ["Red"], feed_info, stops,
    )
    stored = cut_lineage(rail.rail_events(vp, tu))
    events = {(r.trip_id, r.parent_station): r for r in stored.collect()}
    assert len(events) == 6
    last = events[("t1", "place-shmnl")]
    assert (last.vp_move_timestamp, last.vp_stop_timestamp, last.tu_stop_timestamp) == (base + 200, base + 260, base + 265)
    assert last.vehicle_consist == "1800|1801" and last.revenue and last.static_version_key == 7

    calls = spark.createDataFrame(
        [(7, "t1", i + 1, p, 28800 + i * 100, 28810 + i * 100, "s", 0, "Red-A", "Red") for i, p in enumerate(("place-smmnl", "place-fldcr", "place-shmnl"))]
        + [(7, "x9", i + 1, p, 29100 + i * 100, 29110 + i * 100, "s", 0, "Red-A", "Red") for i, p in enumerate(("place-smmnl", "place-fldcr", "place-shmnl"))],
        "static_version_key long, trip_id string, stop_sequence long, parent_station string, arrival_time long, departure_time long, service_id string, direction_id long, branch_route_id string, trunk_route_id string",
    )
    static = {
        "stop_times": calls,
        "trips": calls.select("static_version_key", "trip_id", "branch_route_id", "trunk_route_id").distinct(),
        "directions": spark.createDataFrame([(7, "Red", 0, "South", "Ashmont")], "static_version_key long, route_id string, direction_id long, direction string, direction_destination string"),
        "route_patterns": spark.createDataFrame([(7, "Red", 0, 1, "t1")], "static_version_key long, route_id string, direction_id long, route_pattern_typicality long, representative_trip_id string"),
        "trip_summary": rail.static_trip_summary(
            calls.select(F.lit(20240603).cast("long").alias("service_date"), F.col("trip_id").alias("static_trip_id"), "direction_id", F.lit("Red").alias("route_id"), F.lit("70088").alias("stop_id"), F.col("arrival_time").alias("arrival_seconds")),
            ["service_date", "static_trip_id", "direction_id"],
        ),
    }
    trips = cut_lineage(rail.rail_trips(stored, static))
    by_trip = {r.trip_id: r for r in trips.collect()}
    assert by_trip["t1"].static_trip_id_guess == "t1" and by_trip["t1"].first_last_station_match and by_trip["t1"].static_stop_count == 3
    # t2 has no start time and no schedule: first move, 08:05 local, nearest to x9 at 08:05
    assert by_trip["t2"].start_time == 8 * 3600 + 300 and by_trip["t2"].static_trip_id_guess == "x9" and not by_trip["t2"].first_last_station_match
    assert by_trip["t2"].branch_route_id == "Red-A" and by_trip["t2"].trunk_route_id == "Red" and by_trip["t1"].stop_count == 3
    assert by_trip["t1"].direction_destination == "Ashmont"

    wide = cut_lineage(rail.numbered_events(stored, trips, static))
    assert sorted({(r.parent_station, r.canonical_stop_sequence, r.sync_stop_sequence) for r in wide.collect()}) == [
        ("place-fldcr", 2, 2), ("place-shmnl", 3, 3), ("place-smmnl", 1, 1),
    ]
    measured = cut_lineage(
        rail.rail_metrics(wide, calls.select("static_version_key", F.col("trip_id").alias("static_trip_id"), "parent_station", "stop_sequence"))
    )
    got = {(r.trip_id, r.parent_station): (r.travel_time_seconds, r.dwell_time_seconds, r.headway_trunk_seconds, r.headway_branch_seconds) for r in measured.collect()}
    assert got[("t1", "place-fldcr")] == (60, 40, None, None)
    assert got[("t2", "place-fldcr")] == (60, 40, 300, 300)
    assert got[("t2", "place-smmnl")][:2] == (60, None)

    planned = rail.scheduled_rail_metrics(calls)
    plan = {(r.trip_id, r.stop_sequence): (r.schedule_travel_time_seconds, r.schedule_headway_trunk_seconds) for r in planned.collect()}
    assert plan[("x9", 2)] == (90, 300) and plan[("t1", 1)] == (None, None)
    routes = spark.createDataFrame([(7, "Red", 1)], "static_version_key long, route_id string, route_type long")
    flat = rail.daily_flat_table(measured, planned, routes)
    assert flat.count() == 6 and len(flat.columns) == 27
    assert flat.filter("trip_id = 't2' and stop_sequence = 2").first().scheduled_headway_trunk == 300
    extract = rail.rail_wide_table(measured, stops, routes, (0, 1))
    second = extract.filter("trip_id = 't1' and stop_sequence = 2").first()
    assert (second.previous_stop_name, second.stop_arrival_sec, second.stop_departure_sec) == ("S", 8 * 3600 + 160, 8 * 3600 + 200)
    assert extract.count() == 4
    commuter = rail.rail_wide_table(measured, stops, routes, (0, 1), planned)
    assert commuter.columns == [*extract.columns, "scheduled_arrival_time", "scheduled_departure_time", "scheduled_travel_time", "scheduled_headway_branch", "scheduled_headway_trunk"]
    assert commuter.count() == 4


def test_archive_grows_by_schedules(spark):
    base = scratch_path(spark, "archive")
    tables = schedule_tables(spark)
    first = {"routes": tables["routes"].select(*table_schema("routes").fieldNames()), "feed_info": spark.createDataFrame([], table_schema("feed_info"))}
    changed = first["routes"].withColumn("route_long_name", F.when(F.col("route_id") == "Red", "Red Line").otherwise(F.col("route_long_name")))
    archive.add_schedules(spark, [(20250110, {**first, "routes": changed}), (20240601, first)], base)
    stored = archive.read_archive(spark, base, ["routes"])["routes"]
    red = sorted((r.route_long_name, r.gtfs_active_date, r.gtfs_end_date) for r in stored.filter("route_id = 'Red'").collect())
    assert red == [("Red", 20240602, 20241231), ("Red", 20250101, 20250110), ("Red Line", 20250111, 20260110)]
    bus_rows = sorted((r.gtfs_active_date, r.gtfs_end_date) for r in stored.filter("route_id = 'a'").collect())
    assert bus_rows == [(20240602, 20241231), (20250101, 20260110)]


def feed_document(ts, route="Red", stops=("1", "2")):
    updates = ",".join(f'{{"stop_sequence": {i}, "stop_id": "{s}", "arrival": {{"time": {ts + 60}}}}}' for i, s in enumerate(stops))
    return f'{{"header": {{"timestamp": {ts}}}, "entity": [{{"id": "e", "trip_update": {{"trip": {{"trip_id": "t", "route_id": "{route}"}}, "stop_time_update": [{updates}]}}}}]}}'


def test_feed_batches_merge_into_the_day(spark):
    table, rail_table = scratch_path(spark, "updates"), scratch_path(spark, "updates-rail")

    def batch(*docs):
        return spark.createDataFrame([(f"p{i}", d) for i, d in enumerate(docs)], "path string, document string")

    start = 1717243200
    bad = ingest.ingest_feed(spark, batch(feed_document(start), feed_document(start + 10), "broken"), "RT_TRIP_UPDATES", table, rail_table)
    assert [r.path for r in bad.collect()] == ["p2"]
    assert spark.read.parquet(table).count() == 4
    ingest.ingest_feed(spark, batch(feed_document(start)), "RT_TRIP_UPDATES", table, rail_table)
    assert spark.read.parquet(table).count() == 4
    ingest.ingest_feed(spark, batch(feed_document(start + 86400, route="39")), "RT_TRIP_UPDATES", table, rail_table)
    stored = spark.read.parquet(table)
    assert {(r.month, r.day): r["count"] for r in stored.groupBy("month", "day").count().collect()} == {(6, 1): 4, (6, 2): 2}
    # the repeated batch adds nothing to the rail copy either
    assert spark.read.parquet(rail_table).count() == 4
    assert "trip_update.stop_time_update.stop_id" in stored.columns


def test_alerts_are_published_once(spark):
    path = scratch_path(spark, "alerts-table")
    doc = (
        '{"header": {"timestamp": 1717243200}, "entity": [{"id": "5", "alert": {"cause": "c", "cause_detail": "plain", "effect": "e", "severity": 3, "last_modified_timestamp": 10, '
        '"created_timestamp": 1717243200, "header_text": {"translation": [{"text": "hola", "language": "es"}, {"text": "hi", "language": "en"}]}, '
        '"active_period": [{"start": 1717243200}], "informed_entity": [{"route_id": "Red", "activities": ["BOARD", "EXIT"]}, {"route_id": "Red", "activities": ["BOARD", "EXIT"]}]}}]}'
    )
    parsed = feeds.parse_alerts(spark.createDataFrame([(doc,)], "document string"))
    alerts.append_published(spark, parsed, path)
    alerts.append_published(spark, parsed, path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.id, r.header_text_translation_text, r.cause_detail, r.informed_entity_activities, r.start_month) == (5, "hi", "plain", "BOARD|EXIT", "2024-06")
    assert r.created_datetime.replace(tzinfo=None).hour in (8, 12)


def test_event_bus_tables_and_rules(spark):
    good = '{"id":"1","type":"t","time":"2024-06-01T08:00:00Z","source":"s","specversion":"1.0","data":{"vehicleId":"v","tripKey":{"serviceDate":"2024-06-01","tripId":"x","scheduled":{"a":1}}}}'
    poor = good.replace("2024-06-01\"", "june\"").replace('"id":"1"', '"id":"2"')
    changed = '{"id":"3","type":"t","time":"2024-06-01T08:00:00Z","source":"s","specversion":"1.0","data":{"changes":[{"type":"start"},{"type":"stop"}]}}'
    routed = event_bus.route_records(spark.createDataFrame([(good,), (poor,), (changed,), ('{"id":"4","data":{"other":1}}',)], "value string"))
    assert {r.id: r.kind for r in routed.collect()} == {"1": "vehicle_trip_assignment", "2": "vehicle_trip_assignment", "3": "editor_changes", "4": "unknown"}
    from tramline.operators import validate as V

    table = event_bus.typed_table(routed, "vehicle_trip_assignment")
    assert [r.id for r in V.valid(table, event_bus.rules("vehicle_trip_assignment")).collect()] == ["1"]
    assert table.filter("id = '1'").first().data_tripKey_scheduled == '{"a":1}'
    assert event_bus.typed_table(routed, "editor_changes").count() == 2


def test_every_extract_runs(spark):
    position = (
        "id string, trip_id string, route_id string, direction_id int, start_time string, start_date string, revenue boolean, vehicle_id string, vehicle_label string, "
        "timestamp long, feed_timestamp long, stop_id string, service_date date"
    )
    rows = [("e", "t", "Green-B", 0, "08:00:00", "20240601", True, "v", "l", 1717243200, 1717243210, "70110", dt.date(2024, 6, 1)),
            ("f", "t", "Red", 0, "08:00:00", "20240601", True, "v", "l", 1717243200, 1717243210, "70092", dt.date(2024, 6, 1)),
            ("g", "t", "Green-B", 0, "08:00:00", "20240601", True, "v", "l", 1717243200, 1717243210, "70110", dt.date(2024, 1, 1))]
    positions = spark.createDataFrame(rows, position)
    updates = positions.withColumn("stop_id", F.when(F.col("route_id") == "Red", "70094").otherwise("70106")).withColumns(
        {"departure_time": F.col("timestamp") + 60, "schedule_relationship": F.lit("SCHEDULED"), "stop_schedule_relationship": F.lit("SCHEDULED"),
         "departure_uncertainty": F.lit(5), "boarding_status": F.lit(None).cast("string")}
    )
    for name, spec in extracts.EXTRACTS.items():
        table = updates if "UPDATES" in spec.source else positions
        out = extracts.run_extract(name, table)
        if spec.routes:
            assert [r.route_id for r in out.collect()] == (["Green-B"] if spec.routes == "light_rail" else ["Red"]), name
        assert out.count() == {7: 2, 60: 2, None: 3}.get(spec.days, 2) if not spec.routes and not spec.span else True


def test_schedule_tables_are_declared():
    assert set(SCHEDULE_TABLES) >= {"calendar", "routes", "stops", "stop_times", "trips", "feed_info"}
    assert len(SCHEDULE_TABLES) == 31


@pytest.mark.parametrize("name", sorted(SCHEDULE_TABLES))
def test_every_schedule_table_reads_from_its_file(spark, tmp_path, name):
    """Declared columns in declared types whatever the file has: some missing, some unknown, blanks, repeats."""
    columns = table_schema(name).fields
    first = columns[0]
    value = "text" if first.dataType.simpleString() == "string" else "7"
    (tmp_path / "t.csv").write_text(f"unknown,{first.name}\nx,{value}\ny,{value}\nz,\" \"\n")
    got = read_csv_table(spark, str(tmp_path / "t.csv"), name)
    assert got.schema.simpleString() == table_schema(name).simpleString()
    typed = value if value == "text" else 7
    assert sorted((str(r[0]) for r in got.collect())) == sorted([str(typed), "None"])


def test_new_tables_enter_the_archive(spark):
    base = scratch_path(spark, "archive")
    shape = spark.createDataFrame([("s", "42.5", "-71", "1", " ")], "shape_id string, shape_pt_lat string, shape_pt_lon string, shape_pt_sequence string, shape_dist_traveled string")
    moved = shape.withColumn("shape_pt_lat", F.lit("43"))
    archive.add_schedules(spark, [(20240601, {"shapes": shape}), (20240701, {"shapes": moved})], base)
    rows = sorted((r.shape_pt_lat, r.shape_dist_traveled, r.gtfs_active_date, r.gtfs_end_date) for r in archive.read_archive(spark, base, ["shapes"])["shapes"].collect())
    assert rows == [(42.5, None, 20240602, 20240701), (43.0, None, 20240702, 20250701)]


def versions(table):
    return sorted((r.static_version_key, r.stop_name) for r in table.latest().collect())


def test_schedule_exports_add_newer_versions_only(spark):
    path = scratch_path(spark, "export")
    ddl = "pk_id long, stop_id string, stop_name string, static_version_key long, not_exported string"
    one = spark.createDataFrame([(1, "a", "old", 100, "x"), (2, "b", "old", 200, "x")], ddl)
    assert exports.update(spark, "static_stops", one, path) == ["100", "200"]
    more = one.withColumn("stop_name", F.lit("new")).union(spark.createDataFrame([(3, "c", "new", 300, "x")], ddl))
    assert exports.update(spark, "static_stops", more, path) == ["300"]
    assert versions(exports.stored(spark, "static_stops", path)) == [(100, "old"), (200, "old"), (300, "new")]
    assert exports.update(spark, "static_stops", more, path) == []
    assert exports.stored(spark, "static_stops", path).latest().schema == exports.EXPORTS["static_stops"].schema


def test_the_export_of_a_view_is_renewed_whole(spark):
    path = scratch_path(spark, "export")
    ddl = "route_id string, service_id string, service_date long, static_version_key long"
    one = spark.createDataFrame([("a", "s", 20240101, 100), ("a", "t", 20240102, 200)], ddl)
    exports.update(spark, "service_id_by_date_and_route", one, path)
    # no newer version: nothing happens; with one, older versions follow their rows
    assert exports.update(spark, "service_id_by_date_and_route", one.filter("service_id = 't'"), path) == []
    newer = spark.createDataFrame([("a", "u", 20240102, 200), ("b", "s", 20240103, 300)], ddl)
    assert exports.update(spark, "service_id_by_date_and_route", newer, path) == ["200", "300"]
    kept = exports.stored(spark, "service_id_by_date_and_route", path).latest().collect()
    assert sorted((r.service_id, str(r.service_date_calc)) for r in kept) == [("s", "2024-01-03"), ("u", "2024-01-02")]


def test_event_exports_replace_recent_days(spark):
    path = scratch_path(spark, "export")
    trips = spark.createDataFrame([(i, 20240100 + i) for i in (1, 2, 3)], "pm_trip_id long, service_date long")
    events = spark.createDataFrame([(i, i, 0, i) for i in (1, 2, 3, 4)], "pm_event_id long, pm_trip_id long, vp_move_timestamp long, stop_sequence long")
    known = exports.events_of_trips(events, trips)
    assert exports.update(spark, "vehicle_events", known, path) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    later = known.withColumn("stop_sequence", F.col("stop_sequence") + 10)
    assert exports.update(spark, "vehicle_events", later, path) == ["2024-01-02", "2024-01-03"]
    rows = sorted((str(r.service_date), r.stop_sequence, str(r.vp_move_timestamp)) for r in exports.stored(spark, "vehicle_events", path).latest().collect())
    assert rows == [("2024-01-01", 1, "1969-12-31 19:00:00"), ("2024-01-02", 12, "1969-12-31 19:00:00"), ("2024-01-03", 13, "1969-12-31 19:00:00")]


def test_versioned_tables_keep_other_versions(spark):
    base = scratch_path(spark, "versions")
    table = spark.createDataFrame([("a",)], "route_id string")
    ingest.versioned_tables({"feed_info": table, "routes": table}, 100, base)
    ingest.versioned_tables({"routes": table}, 200, base)
    assert sorted(r.timestamp for r in spark.read.parquet(f"{base}/routes").collect()) == [100, 200]


def test_a_batch_replaces_its_own_rail_rows(spark):
    start = 1717243200
    docs = [feed_document(start + 10 * i, stops=("1", "1")) for i in range(3)]  # equal rows in one document stay

    def copy(*batches):
        table, rail_table = scratch_path(spark, "updates"), scratch_path(spark, "updates-rail")
        for batch in batches:
            found = spark.createDataFrame([(f"p{i}", d) for i, d in enumerate(batch)], "path string, document string")
            ingest.ingest_feed(spark, found, "RT_TRIP_UPDATES", table, rail_table)
        return sorted((r.feed_timestamp, r["trip_update.stop_time_update.stop_sequence"]) for r in spark.read.parquet(rail_table).collect())

    once = copy(docs)
    assert len(once) == 6 and copy(docs[:1], docs[1:]) == once and copy(docs, docs[1:]) == once


def test_all_feed_layouts_keep_their_fields(spark):
    trip = '"trip": {"trip_id": "t", "route_id": "Red", "direction_id": 0, "start_time": "08:00:00", "start_date": "20240601", "tm_trip_id": "9", "overload_id": 3}'
    vehicle = '"vehicle": {"id": "v", "label": "1800", "consist": [{"label": "1800"}, {"label": "1801"}], "assignment_status": "A"}'
    position = f'{{"id": "e", "is_deleted": false, "vehicle": {{{trip}, {vehicle}, "position": {{"latitude": 42.0, "odometer": 5.5}}, "current_stop_sequence": 3, "stop_id": "70086", "timestamp": 1717243100, "current_status": "STOPPED_AT", "congestion_level": "LOW", "operator": {{"id": "o"}}, "load": 4, "multi_carriage_details": [{{"label": "1800", "carriage_sequence": 1}}]}}}}'
    update = f'{{"id": "e", "trip_update": {{{trip}, {vehicle}, "trip_properties": {{"trip_headsign": "h"}}, "stop_time_update": [{{"stop_id": "70086", "arrival": {{"time": 1717243300}}, "cause_id": 5, "remark": "r"}}]}}}}'
    alert = '{"id": "e", "alert": {"cause": "c", "url": {"translation": [{"text": "u", "language": "en"}]}, "reminder_times": [5], "informed_entity": [{"agency_id": "1", "trip": {"trip_id": "t"}}]}}'
    found = {}
    for feed, layout in feeds.FEEDS.items():
        entity = alert if feed == "RT_ALERTS" else update if feed.endswith("UPDATES") else position
        doc = f'{{"header": {{"timestamp": 1717243200}}, "entity": [{entity}]}}'
        table = scratch_path(spark, feed)
        ingest.ingest_feed(spark, spark.createDataFrame([("p", doc)], "path string, document string"), feed, table)
        found[feed] = spark.read.parquet(table)
        assert found[feed].count() == 1 and layout.sort in found[feed].columns
    bus_row = found["BUS_VEHICLE_POSITIONS"].first()
    assert (bus_row["vehicle.operator.id"], bus_row["vehicle.load"], bus_row["vehicle.trip.overload_id"], bus_row["is_deleted"]) == ("o", 4, 3, False)
    assert found["BUS_TRIP_UPDATES"].first()["trip_update.stop_time_update.cause_id"] == 5
    assert found["RT_TRIP_UPDATES"].first()["trip_update.trip_properties.trip_headsign"] == "h"
    assert found["RT_ALERTS"].first()["alert.informed_entity"][0]["trip"]["trip_id"] == "t"
    rail_row = feeds.rail_position_rows(found["RT_VEHICLE_POSITIONS"]).first()
    assert ([c["label"] for c in rail_row.vehicle_consist], rail_row.multi_carriage_details[0]["carriage_sequence"]) == (["1800", "1801"], 1)
    assert feeds.bus_position_rows(found["BUS_VEHICLE_POSITIONS"]).first().latitude == 42.0
    predicted = feeds.prediction_rows(found["RT_TRIP_UPDATES"]).first()
    assert (predicted.timestamp, predicted.tu_stop_timestamp, predicted.start_time, predicted.service_date) == (1717243200, 1717243300, 28800, 20240601)
    older = found["RT_VEHICLE_POSITIONS"].drop("vehicle.vehicle.consist", "vehicle.multi_carriage_details")
    assert feeds.rail_position_rows(older).first().vehicle_consist is None


def test_bus_extracts_publish_local_clocks(spark):
    instant = dt.datetime(2025, 9, 2, 3, 30, tzinfo=dt.timezone.utc)  # 23:30 on the first in Boston
    winter = dt.datetime(2025, 12, 2, 13, 0, tzinfo=dt.timezone.utc)  # 08:00
    table = spark.createDataFrame(
        [(dt.date(2025, 9, 1), "a", instant, None, 5), (dt.date(2025, 12, 2), "b", winter, winter, 6)],
        "service_date date, trip_id string, stop_arrival_dt timestamp, stop_departure_dt timestamp, stop_arrival_seconds long",
    )
    for name in ("bus_metrics_all", "bus_metrics_fall_2025"):
        out = extracts.run_extract(name, table)
        found = {r.trip_id: r for r in out.collect()}
        assert found["a"].stop_arrival_dt == dt.datetime(2025, 9, 1, 23, 30) and found["b"].stop_departure_dt == dt.datetime(2025, 12, 2, 8)
        assert (found["a"].stop_arrival_seconds, found["a"].stop_departure_seconds, found["b"].stop_departure_seconds) == (84600, None, 28800)
        assert dict(out.dtypes)["stop_arrival_dt"] == "timestamp_ntz"
    assert [r.trip_id for r in extracts.run_extract("bus_metrics_7_day", table).collect()] == ["b"]


def test_trip_steps_of_small_trips_share_one_shuffle(spark):
    """Steps along a trip write nothing and deal the rows once when no trip is large."""
    at = "timestamp'2025-01-06 12:00:00'"
    columns = [
        "date'2025-01-06' as service_date", "'t' as trip_id", "'p' as tm_pullout_id", "'v' as vehicle_label", "'s' as stop_id", "id as stop_sequence",
        "3L as stop_count", "'mid' as point_type", *[f"{at} as {c}" for c in (
            "gtfs_departure_dt", "gtfs_arrival_dt", "tm_actual_departure_dt", "tm_actual_arrival_dt", "gtfs_last_in_transit_dt",
            "gtfs_first_in_transit_dt", "plan_stop_departure_dt")],
    ]
    rows = spark.range(1, 4).selectExpr(*columns)
    small, large = bus.trip_times(rows, True), bus.trip_times(rows, False)
    assert small.columns == large.columns and sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange") == 1


def test_feed_files_are_cut_and_bear_their_documents_time(spark, tmp_path):
    from tramline.workload import jobs
    from tramline.workload.registry import Tables

    # two files of one document, their ids 500,000 apart, in one week
    spark.range(40).selectExpr(
        "id * 25000 as event_id", "timestamp_seconds(1704110400 + id) as ts", "id as user_id", "'click' as event_type", "1.0 as value", "'{\"k\": 1}' as props"
    ).write.parquet(str(tmp_path / "events.parquet"))
    jobs._feed_files(Tables(spark, str(tmp_path)), F.lit("RT_VEHICLE_POSITIONS"), str(tmp_path / "files"))
    found = feeds.read_documents(spark, str(tmp_path / "files/feed=*/*"))
    rows = feeds.entity_rows(feeds.parse_documents(found, feeds.FEEDS["RT_VEHICLE_POSITIONS"].entity))
    assert found.count() == 2
    assert sorted(int(r.id) for r in rows.collect()) == [i * 25000 for i in range(40)]
    assert {r.feed_timestamp for r in rows.collect()} == {1704110439}
