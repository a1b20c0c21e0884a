"""Window operators (section 2.6 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators import aggregates, metrics
from tramline.operators.events import drop_out_of_order
from tramline.operators.groups import with_group_values
from tramline.operators.scan import fine_stretch, stretch, time_stretch
from tramline.session import cut_lineage
from tramline.workload.registry import query
from tramline.workload.standins import POSITIONS, RAIL_EVENTS, STOP_TIMES, TRIPS, positions, rail_events, stop_times, text, trips

_TRIP = ["service_date", "pm_trip_id"]


def _by_part():
    """Line numbers repeat within an order without bound: each is cut by part."""
    return fine_stretch(F.col("stop_sequence"), F.col("part"), 50_000)


def _by_trip():
    """Planned seconds repeat across days and lines: each is cut by trip."""
    return fine_stretch(F.col("departure_seconds"), F.col("trip_id"), 1_000_000)


@query(f"""
WITH {STOP_TIMES}
SELECT trip_id, stop_sequence, part, stop_id, arrival_seconds - lag(departure_seconds) OVER (PARTITION BY trip_id ORDER BY stop_sequence, part, stop_id, departure_seconds) AS plan_travel_time_seconds
FROM stop_times
""")
def plan_travel_time(t):
    timed = metrics.plan_travel_time(stop_times(t), ["trip_id"], "stop_sequence", ["part", "stop_id", "departure_seconds"], _by_part())
    return timed.select("trip_id", "stop_sequence", "part", "stop_id", "plan_travel_time_seconds")


_PLANNED_SQL = f"""{STOP_TIMES}, {TRIPS},
planned AS (SELECT s.*, route_id, direction_id, service_id, static_version_key FROM stop_times s JOIN trips USING (trip_id))"""


def _planned(t):
    return stop_times(t).join(trips(t), "trip_id")


_TIE = ["trip_id", "stop_sequence", "part"]



@query(f"""
WITH {_PLANNED_SQL}
SELECT trip_id, stop_sequence, part, stop_id, departure_seconds - lag(departure_seconds) OVER (PARTITION BY stop_id, direction_id, route_id ORDER BY departure_seconds, trip_id, stop_sequence, part) AS headway
FROM planned
""")
def plan_headway_route(t):
    found = metrics.headway(_planned(t), ["stop_id", "direction_id", "route_id"], F.col("departure_seconds"), "headway", _TIE, split=_by_trip())
    return found.select("trip_id", "stop_sequence", "part", "stop_id", "headway")


@query(f"""
WITH {_PLANNED_SQL}
SELECT trip_id, stop_sequence, part, stop_id, departure_seconds - lag(departure_seconds) OVER (PARTITION BY stop_id, service_id ORDER BY departure_seconds, trip_id, stop_sequence, part) AS headway
FROM planned
""")
def plan_headway_destination(t):
    found = metrics.headway(_planned(t), ["stop_id", "service_id"], F.col("departure_seconds"), "headway", _TIE, split=_by_trip())
    return found.select("trip_id", "stop_sequence", "part", "stop_id", "headway")


def _lines(t):
    stations = t.supplier.select(F.col("s_suppkey").alias("stop_id"), F.col("s_nationkey").alias("parent_station"))
    trunk = F.when(F.substring("route_id", 1, 1) < "3", F.lit("Green")).otherwise(F.col("route_id"))
    return _planned(t).join(stations, "stop_id").withColumn("branch_route_id", F.when(F.col("route_id") != "5-LOW", F.col("route_id"))).withColumn(
        "trunk_route_id", trunk
    )


_LINES_SQL = f"""{_PLANNED_SQL},
lines AS (SELECT p.*, s_nationkey AS parent_station, CASE WHEN route_id <> '5-LOW' THEN route_id END AS branch_route_id,
  CASE WHEN substr(route_id, 1, 1) < '3' THEN 'Green' ELSE route_id END AS trunk_route_id FROM planned p JOIN supplier ON stop_id = s_suppkey)"""


@query(f"""
WITH {_LINES_SQL}
SELECT trip_id, stop_sequence, part, departure_seconds - lag(departure_seconds) OVER (PARTITION BY parent_station, service_id, direction_id, branch_route_id
  ORDER BY departure_seconds, trip_id, stop_sequence, part) AS headway FROM lines WHERE branch_route_id IS NOT NULL
""")
def plan_headway_branch(t):
    on_line = _lines(t).filter(F.col("branch_route_id").isNotNull())
    keys = ["parent_station", "service_id", "direction_id", "branch_route_id"]
    return metrics.headway(on_line, keys, F.col("departure_seconds"), "headway", _TIE, split=_by_trip()).select(
        "trip_id", "stop_sequence", "part", "headway"
    )


@query(f"""
WITH {_LINES_SQL}
SELECT trip_id, stop_sequence, part, departure_seconds - lag(departure_seconds) OVER (PARTITION BY parent_station, service_id, direction_id, trunk_route_id
  ORDER BY departure_seconds, trip_id, stop_sequence, part) AS headway FROM lines
""")
def plan_headway_trunk(t):
    keys = ["parent_station", "service_id", "direction_id", "trunk_route_id"]
    return metrics.headway(_lines(t), keys, F.col("departure_seconds"), "headway", _TIE, split=_by_trip()).select(
        "trip_id", "stop_sequence", "part", "headway"
    )


@query(f"""
WITH {RAIL_EVENTS}, ids AS (SELECT *, service_date * 1000000 + pm_trip_id * 100 + stop_sequence AS pm_event_id FROM rail_events)
SELECT pm_event_id, lead(pm_event_id) OVER w AS next_trip_stop, lag(pm_event_id) OVER w AS previous_trip_stop FROM ids WINDOW w AS (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence)
""")
def prev_next_stop(t):
    ids = rail_events(t).withColumn(
        "pm_event_id", F.col("service_date") * 1000000 + F.col("pm_trip_id") * 100 + F.col("stop_sequence")
    )
    linked = metrics.trip_neighbours(
        ids, _TRIP, ["stop_sequence"], {"next_trip_stop": ("next", "pm_event_id"), "previous_trip_stop": ("previous", "pm_event_id")}
    )
    return linked.select("pm_event_id", "next_trip_stop", "previous_trip_stop")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence, lag(stop_id) OVER w IS NULL AS rt_first_stop, lead(stop_id) OVER w IS NULL AS rt_last_stop, rank() OVER w AS rt_stop_rank
FROM rail_events WINDOW w AS (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence)
""")
def first_last_flags_rank(t):
    flagged = metrics.first_last_rank(rail_events(t), _TRIP, ["stop_sequence"], "rt")
    return flagged.select(*_TRIP, "stop_sequence", "rt_first_stop", "rt_last_stop", "rt_stop_rank")


@query(f"""
WITH {POSITIONS}, reps AS (SELECT route_id, direction_id, user_id, max(k) % 7 AS typicality FROM positions GROUP BY 1, 2, 3),
chosen AS (SELECT route_id, direction_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY route_id, direction_id ORDER BY typicality DESC, user_id) AS n FROM reps WHERE typicality IN (1, 5)) WHERE n = 1),
calls AS (SELECT user_id, stop_sequence, min(parent_station) AS parent_station FROM positions GROUP BY 1, 2)
SELECT route_id, direction_id, parent_station, row_number() OVER (PARTITION BY route_id, direction_id ORDER BY c.stop_sequence, parent_station) AS stop_sequence
FROM chosen JOIN calls c USING (user_id)
""")
def canonical_sequence(t):
    p = positions(t)
    patterns = p.groupBy("route_id", "direction_id", F.col("user_id").alias("representative_trip_id")).agg(
        (F.max("k") % 7).alias("route_pattern_typicality")
    ).withColumn("static_version_key", F.lit(1))
    calls = p.groupBy(F.col("user_id").alias("trip_id"), "stop_sequence").agg(F.min("parent_station").alias("parent_station")).withColumn(
        "static_version_key", F.lit(1)
    )
    return aggregates.canonical_sequences(patterns, calls).select("route_id", "direction_id", "parent_station", "stop_sequence")


@query(f"""
WITH {RAIL_EVENTS}, gaps AS (SELECT service_date, pm_trip_id, stop_sequence, CASE WHEN tu_stop_timestamp IS NOT NULL THEN stop_id END AS block FROM rail_events)
SELECT service_date, pm_trip_id, stop_sequence, coalesce(block, last_value(block IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(block IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS block FROM gaps WINDOW w AS (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence)
""")
def fill_both_ways(t):
    gaps = rail_events(t).select(*_TRIP, "stop_sequence", F.when(F.col("tu_stop_timestamp").isNotNull(), F.col("stop_id")).alias("block"))
    return metrics.fill_trip_columns(gaps, _TRIP, ["stop_sequence"], ["block"])


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence, rank() OVER (PARTITION BY service_date, pm_trip_id ORDER BY vp_stop_timestamp NULLS FIRST, vp_move_timestamp NULLS FIRST, tu_stop_timestamp NULLS FIRST) AS rank
FROM rail_events
""")
def struct_rank(t):
    ranked = metrics.stop_sequence_rank(
        rail_events(t), _TRIP, ["vp_move_timestamp", "tu_stop_timestamp"], F.col("vp_stop_timestamp"), "rank"
    )
    return ranked.select(*_TRIP, "stop_sequence", "rank")


@query(f"""
WITH {RAIL_EVENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence) AS seq FROM rail_events)
SELECT service_date, pm_trip_id, stop_sequence, CASE WHEN seq = 1 THEN 'start' WHEN seq = max(seq) OVER (PARTITION BY service_date, pm_trip_id) THEN 'end' WHEN tu_stop_timestamp IS NOT NULL THEN 'mid' END AS point_type FROM r
""")
def point_type(t):
    ranked = metrics.numbered(rail_events(t), _TRIP, [F.col("stop_sequence")], stretch(F.col("stop_sequence"), 4), "seq")
    pointed = metrics.point_type(ranked, _TRIP, "seq", F.col("tu_stop_timestamp").isNotNull())
    return pointed.select(*_TRIP, "stop_sequence", "point_type")


@query(f"""
WITH {POSITIONS}
SELECT event_id, dense_rank() OVER (PARTITION BY route_id ORDER BY stop_sequence) AS timepoint_order, min(stop_sequence) OVER (PARTITION BY trip_id) AS tm_planned_sequence_start,
  max(stop_sequence) OVER (PARTITION BY trip_id) AS tm_planned_sequence_end FROM positions
""")
def dense_rank_order(t):
    ordered_ = metrics.timepoint_order(positions(t), ["route_id"], ["trip_id"], "stop_sequence")
    return ordered_.select("event_id", "timepoint_order", "tm_planned_sequence_start", "tm_planned_sequence_end")


@query(f"""
WITH {RAIL_EVENTS}, k AS (SELECT *, CASE WHEN stop_sequence < 4 THEN 'start' WHEN stop_sequence > 6 THEN 'end' WHEN tu_stop_timestamp IS NOT NULL THEN 'mid' END AS point_type FROM rail_events)
SELECT service_date, pm_trip_id, stop_sequence, coalesce(bool_or(point_type = 'start') OVER w, false) AND coalesce(bool_or(point_type = 'end') OVER w, false) AS is_full_trip FROM k WINDOW w AS (PARTITION BY service_date, pm_trip_id)
""")
def is_full_trip(t):
    kind = F.when(F.col("stop_sequence") < 4, "start").when(F.col("stop_sequence") > 6, "end").when(F.col("tu_stop_timestamp").isNotNull(), "mid")
    flagged = metrics.full_trip_flag(rail_events(t).withColumn("point_type", kind), _TRIP)
    return flagged.select(*_TRIP, "stop_sequence", "is_full_trip")


@query(f"""
WITH {RAIL_EVENTS}, f AS (SELECT *, max(greatest(vp_move_timestamp, vp_stop_timestamp)) OVER (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS floor_at FROM rail_events)
SELECT service_date, pm_trip_id, stop_sequence, CASE WHEN vp_move_timestamp IS NOT NULL THEN greatest(vp_move_timestamp, floor_at) END AS vp_move_timestamp,
  CASE WHEN vp_stop_timestamp IS NOT NULL THEN greatest(vp_stop_timestamp, floor_at) END AS vp_stop_timestamp FROM f
""")
def running_max_clamp(t):
    clamped = metrics.clamp_to_earlier_stops(rail_events(t), _TRIP, ["stop_sequence"], ["vp_move_timestamp", "vp_stop_timestamp"])
    return clamped.select(*_TRIP, "stop_sequence", "vp_move_timestamp", "vp_stop_timestamp")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence, coalesce(vp_stop_timestamp, vp_move_timestamp) - last_value(coalesce(vp_move_timestamp, vp_stop_timestamp) IGNORE NULLS) OVER (
  PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS travel_time_seconds FROM rail_events
""")
def travel_time_ffill(t):
    timed = metrics.travel_time(rail_events(t), _TRIP, ["stop_sequence"], "vp_stop_timestamp", "vp_move_timestamp")
    return timed.select(*_TRIP, "stop_sequence", "travel_time_seconds")


_SEEN_SQL = f"""{RAIL_EVENTS}, seen AS (SELECT *, coalesce(vp_move_timestamp, vp_stop_timestamp, tu_stop_timestamp) AS seen_at FROM rail_events)"""


@query(f"""
WITH {_SEEN_SQL}
SELECT service_date, pm_trip_id, stop_sequence, seen_at - lag(seen_at) OVER (PARTITION BY service_date, stop_id, direction_id, route_id ORDER BY seen_at, pm_trip_id, stop_sequence) AS headway FROM seen
""")
def imputed_headway_route(t):
    at = F.coalesce("vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp")
    found = metrics.headway(rail_events(t), ["service_date", "stop_id", "direction_id", "route_id"], at, "headway", ["pm_trip_id", "stop_sequence"])
    return found.select(*_TRIP, "stop_sequence", "headway")


@query(f"""
WITH {_SEEN_SQL}
SELECT service_date, pm_trip_id, stop_sequence, seen_at - lag(seen_at) OVER (PARTITION BY service_date, stop_id, direction_id ORDER BY seen_at, pm_trip_id, stop_sequence) AS headway FROM seen
""")
def imputed_headway_destination(t):
    at = F.coalesce("vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp")
    found = metrics.headway(rail_events(t), ["service_date", "stop_id", "direction_id"], at, "headway", ["pm_trip_id", "stop_sequence"])
    return found.select(*_TRIP, "stop_sequence", "headway")


_COUNTED_SQL = f"""{RAIL_EVENTS}, counted AS (SELECT *, count(*) OVER (PARTITION BY service_date, pm_trip_id) AS stop_count, stop_sequence = min(stop_sequence) OVER (PARTITION BY service_date, pm_trip_id) AS first_stop_flag,
  tu_stop_timestamp IS NULL OR vp_move_timestamp IS NOT NULL AS revenue, CASE WHEN route_id LIKE 'Green%' THEN route_id END AS branch_route_id, CASE WHEN route_id LIKE 'Green%' THEN 'Green' ELSE route_id END AS trunk_route_id FROM rail_events)"""


def _counted(t):
    counted = with_group_values(rail_events(t), _TRIP, stop_count=F.count(F.lit(1)), _first=F.min("stop_sequence"))
    green = F.col("route_id").startswith("Green")
    return counted.select(
        "*",
        (F.col("stop_sequence") == F.col("_first")).alias("first_stop_flag"),
        (F.col("tu_stop_timestamp").isNull() | F.col("vp_move_timestamp").isNotNull()).alias("revenue"),
        F.when(green, F.col("route_id")).alias("branch_route_id"),
        F.when(green, "Green").otherwise(F.col("route_id")).alias("trunk_route_id"),
    )


@query(f"""
WITH {_COUNTED_SQL}, gone AS (SELECT service_date, pm_trip_id, stop_sequence, lead(vp_move_timestamp) OVER (PARTITION BY service_date, pm_trip_id ORDER BY coalesce(vp_move_timestamp, vp_stop_timestamp) NULLS FIRST, stop_sequence) - vp_stop_timestamp AS d
  FROM counted WHERE NOT first_stop_flag AND stop_count > 1)
SELECT service_date, pm_trip_id, stop_sequence, CASE WHEN d > 0 THEN d END AS dwell_time_seconds FROM gone
""")
def dwell_time(t):
    stops = _counted(t).withColumnsRenamed({"vp_move_timestamp": "move_timestamp", "vp_stop_timestamp": "stop_timestamp"})
    return metrics.rail_dwell_time(stops, _TRIP, ["stop_sequence"]).select(*_TRIP, "stop_sequence", "dwell_time_seconds")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence, CASE WHEN vp_stop_timestamp > vp_move_timestamp THEN vp_stop_timestamp - vp_move_timestamp END AS travel_time_seconds FROM rail_events
""")
def travel_time_rail(t):
    travel = metrics.rail_travel_time(F.col("vp_move_timestamp"), F.col("vp_stop_timestamp"))
    return rail_events(t).select(*_TRIP, "stop_sequence", travel.alias("travel_time_seconds"))


_LEAVING_SQL = f"""{_COUNTED_SQL}, leaving AS (SELECT *, lead(vp_move_timestamp) OVER (PARTITION BY service_date, pm_trip_id ORDER BY coalesce(vp_move_timestamp, vp_stop_timestamp) NULLS FIRST, stop_sequence) AS next_station_move
  FROM counted WHERE stop_count > 1 AND revenue)"""


def _headway_rail(t, line):
    leaving = cut_lineage(
        metrics.next_station_move(cut_lineage(_counted(t), "counted"), _TRIP, ["stop_sequence"]), "leaving"
    )
    return metrics.rail_headway(leaving, line, "headway", _TRIP).select(*_TRIP, "stop_sequence", "headway")


@query(f"""
WITH {_LEAVING_SQL}, h AS (SELECT *, next_station_move - lag(next_station_move) OVER (PARTITION BY parent_station, branch_route_id, direction_id ORDER BY next_station_move NULLS FIRST, service_date, pm_trip_id) AS d FROM leaving WHERE branch_route_id IS NOT NULL)
SELECT service_date, pm_trip_id, stop_sequence, CASE WHEN d > 0 THEN d END AS headway FROM h
""")
def headway_branch(t):
    return _headway_rail(t, "branch_route_id")


@query(f"""
WITH {_LEAVING_SQL}, h AS (SELECT *, next_station_move - lag(next_station_move) OVER (PARTITION BY parent_station, trunk_route_id, direction_id ORDER BY next_station_move NULLS FIRST, service_date, pm_trip_id) AS d FROM leaving)
SELECT service_date, pm_trip_id, stop_sequence, CASE WHEN d > 0 THEN d END AS headway FROM h
""")
def headway_trunk(t):
    return _headway_rail(t, "trunk_route_id")


@query(f"""
WITH {POSITIONS}
SELECT event_id, min(epoch) OVER w AS feed_timestamp_first_prediction, max(epoch) OVER w AS feed_timestamp_last_prediction FROM positions WINDOW w AS (PARTITION BY trip_id, service_date, stop_sequence)
""")
def prediction_validity(t):
    from tramline.plans.extracts import prediction_validity as validity

    rows = positions(t).select("event_id", "trip_id", F.col("service_date").alias("timestamp"), F.col("stop_sequence").alias("departure_time"), F.col("epoch").alias("feed_timestamp"))
    return validity(rows).select("event_id", "feed_timestamp_first_prediction", "feed_timestamp_last_prediction")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence, count(*) OVER w AS stop_count, max(stop_sequence) OVER w AS last_sequence FROM rail_events WINDOW w AS (PARTITION BY service_date, pm_trip_id)
""")
def stop_count_over(t):
    counted = with_group_values(rail_events(t), _TRIP, stop_count=F.count(F.lit(1)), last_sequence=F.max("stop_sequence"))
    return counted.select(*_TRIP, "stop_sequence", "stop_count", "last_sequence")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, vehicle_label, trip_id, stop_sequence, lag(stop_id) OVER (PARTITION BY service_date, vehicle_label, trip_id ORDER BY stop_sequence) AS previous_stop_id FROM rail_events
""")
def previous_stop(t):
    linked = metrics.trip_neighbours(
        rail_events(t), ["service_date", "vehicle_label", "trip_id"], ["stop_sequence"], {"previous_stop_id": ("previous", "stop_id")}
    )
    return linked.select("service_date", "vehicle_label", "trip_id", "stop_sequence", "previous_stop_id")


@query(f"""
WITH {STOP_TIMES}
SELECT trip_id, stop_sequence, part, stop_id, lead(stop_sequence) OVER (PARTITION BY trip_id ORDER BY stop_sequence, part, stop_id) - stop_sequence AS sequence_diff FROM stop_times
""")
def sequence_diff_check(t):
    gaps = metrics.sequence_gaps(stop_times(t), ["trip_id"], "stop_sequence", ["part", "stop_id"], _by_part())
    return gaps.select("trip_id", "stop_sequence", "part", "stop_id", "sequence_diff")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence, coalesce(CASE WHEN max(stop_sequence) OVER (PARTITION BY service_date, pm_trip_id) > stop_sequence THEN vp_stop_timestamp END, tu_stop_timestamp) AS departed FROM rail_events
""")
def trip_advanced(t):
    from tramline.plans.stop_events import departed_when_advanced

    rows = rail_events(t).withColumnsRenamed({"vp_stop_timestamp": "latest_stopped_timestamp", "tu_stop_timestamp": "departed"})
    return departed_when_advanced(rows, _TRIP).select(*_TRIP, "stop_sequence", "departed")


_FLAGSHIP_SQL = f"""{POSITIONS},
kept AS (SELECT * FROM (SELECT *, min(stop_sequence) OVER (PARTITION BY service_date, user_id ORDER BY vehicle_timestamp, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lowest FROM positions) WHERE stop_sequence <= lowest),
ev AS (SELECT service_date, user_id, stop_sequence, count(*) AS n, min(epoch) FILTER (current_status = 'STOPPED_AT') AS arrival, max(epoch) FILTER (current_status = 'STOPPED_AT') AS departure,
  max(epoch) FILTER (current_status <> 'STOPPED_AT') AS last_moving FROM kept GROUP BY ALL),
fl AS (SELECT *, max(greatest(arrival, departure, last_moving)) OVER (PARTITION BY service_date, user_id ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS floor_at FROM ev),
cl AS (SELECT service_date, user_id, stop_sequence, n, CASE WHEN arrival IS NOT NULL THEN greatest(arrival, floor_at) END AS arrival, CASE WHEN departure IS NOT NULL THEN greatest(departure, floor_at) END AS departure FROM fl),
tr AS (SELECT *, coalesce(arrival, departure) - last_value(coalesce(departure, arrival) IGNORE NULLS) OVER (PARTITION BY service_date, user_id ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS travel_time_seconds,
  departure - lag(departure) OVER (PARTITION BY stop_sequence ORDER BY departure NULLS FIRST, service_date, user_id) AS gap FROM cl)"""


@query(f"""
WITH {_FLAGSHIP_SQL}
SELECT strftime(service_date, '%Y-%m-%d') AS service_date, user_id, stop_sequence, n, arrival, departure, travel_time_seconds, departure - arrival AS dwell_seconds, CASE WHEN gap > 0 THEN gap END AS headway_seconds FROM tr
""")
def stop_event_metrics(t):
    """Flagship: positions, out-of-order records out, stop events, repaired times, travel, dwell, headway."""
    trip = ["service_date", "user_id"]
    p = positions(t).select(*trip, "stop_sequence", "event_id", "vehicle_timestamp", "epoch", "current_status")
    kept = drop_out_of_order(
        p, trip, "stop_sequence", [F.col("vehicle_timestamp"), F.col("event_id")], time_stretch(F.col("vehicle_timestamp"), 60)
    )
    stopped = F.col("current_status") == "STOPPED_AT"
    stops = kept.groupBy(*trip, "stop_sequence").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(stopped, F.col("epoch"))).alias("arrival"),
        F.max(F.when(stopped, F.col("epoch"))).alias("departure"),
        F.max(F.when(~stopped, F.col("epoch"))).alias("last_moving"),
    )
    clamped = metrics.clamp_to_earlier_stops(
        cut_lineage(stops, "stops"), trip, ["stop_sequence"], ["arrival", "departure"], also=["last_moving"]
    )
    travelled = metrics.travel_time(cut_lineage(clamped, "clamped"), trip, ["stop_sequence"], "arrival", "departure")
    measured = metrics.headway(
        travelled, ["stop_sequence"], F.col("departure"), "headway_seconds", trip, positive_only=True
    )
    return measured.select(
        text(F.col("service_date")).alias("service_date"), "user_id", "stop_sequence", "n", "arrival", "departure", "travel_time_seconds",
        (F.col("departure") - F.col("arrival")).alias("dwell_seconds"), "headway_seconds",
    )
