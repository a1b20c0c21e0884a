"""Composite jobs and streams (sections 2.2, 2.4, 2.9 and 2.10 of the inventory)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators import events, filters
from tramline.operators import validate as V
from tramline.plans import alerts, bus, ingest, rail, stop_events
from tramline.session import cut_lineage, scratch_path
from tramline.sinks.versions import DatedTable
from tramline.sources import feeds
from tramline.streaming import jobs as streams
from tramline.streaming.state import VersionedTable
from tramline.workload.aggregations import _KEPT_SQL
from tramline.workload.registry import query
from tramline.workload.standins import POSITIONS, RAIL_EVENTS, positions, rail_events, text
from tramline.workload.windows import _counted, _COUNTED_SQL

# Bus -----------------------------------------------------------------------

_PLAN_SQL = """(5 + user_id % 21) * 3600 + (user_id % 60) * 60 + stop_sequence * 600"""

_SCHEDULES_SQL = f"""{_KEPT_SQL},
g AS (SELECT service_date, regexp_replace(trip_id, '_[0-9]', '') AS trip_id, stop_sequence AS gtfs_stop_sequence, stop_id, route_id, direction_id, 'b' || user_id % 5 AS block_id,
    CAST(service_date AS TIMESTAMP) + INTERVAL 1 SECOND * ({_PLAN_SQL}) AS plan_at, CASE WHEN stop_sequence % 2 = 0 THEN 'chk' END AS checkpoint_id
  FROM positions WHERE event_type <> 'error' GROUP BY ALL),
tm AS (SELECT service_date, regexp_replace(regexp_replace(trip_id, '-OL[0-9]?', ''), '_[0-9]', '') AS trip_id, stop_sequence AS tm_stop_sequence, stop_id, route_id, 'p' || user_id % 3 AS pullout,
    CAST(service_date AS TIMESTAMP) + INTERVAL 1 SECOND * ({_PLAN_SQL} + CASE WHEN (user_id + stop_sequence) % 4 = 0 THEN 30 ELSE 0 END) AS tm_at, vehicle_label, user_id % 9 AS pattern_id,
    CASE WHEN stop_sequence % 3 = 0 THEN 'tp' END AS timepoint_abbr FROM positions WHERE event_type <> 'view' GROUP BY ALL),
known AS (SELECT g.*, tm.tm_stop_sequence, tm.pullout FROM g LEFT JOIN tm ON g.service_date = tm.service_date AND g.trip_id = tm.trip_id AND g.stop_id = tm.stop_id AND g.plan_at = tm.tm_at
  WHERE (g.service_date, g.trip_id) IN (SELECT (service_date, trip_id) FROM tm)),
full_rows AS (SELECT coalesce(k.service_date, m.service_date) AS service_date, coalesce(k.trip_id, m.trip_id) AS trip_id, coalesce(k.stop_id, m.stop_id) AS stop_id, k.gtfs_stop_sequence,
    coalesce(k.tm_stop_sequence, m.tm_stop_sequence) AS tm_stop_sequence, coalesce(k.pullout, m.pullout) AS pullout, coalesce(k.route_id, m.route_id) AS route_id, k.block_id, k.direction_id,
    coalesce(m.tm_at, k.plan_at) AS plan_at, k.checkpoint_id, m.timepoint_abbr, m.vehicle_label, m.pattern_id
  FROM known k FULL JOIN tm m ON k.service_date = m.service_date AND k.trip_id = m.trip_id AND k.pullout = m.pullout AND k.stop_id = m.stop_id AND k.tm_stop_sequence = m.tm_stop_sequence
  UNION ALL BY NAME SELECT service_date, trip_id, stop_id, gtfs_stop_sequence, route_id, block_id, direction_id, plan_at, checkpoint_id FROM g WHERE (service_date, trip_id) NOT IN (SELECT (service_date, trip_id) FROM tm)),
pulled AS (SELECT *EXCLUDE (pullout), coalesce(pullout, max(pullout) OVER (PARTITION BY service_date, trip_id)) AS pullout FROM full_rows),
filled AS (SELECT *EXCLUDE (block_id, direction_id), coalesce(block_id, max(block_id) OVER w) AS block_id, coalesce(direction_id, max(direction_id) OVER w) AS direction_id FROM pulled WINDOW w AS (PARTITION BY service_date, trip_id, pullout)),
ranked AS (SELECT *, coalesce(pullout, '____') AS tm_pullout_id, CASE WHEN gtfs_stop_sequence IS NULL THEN 'TM' WHEN tm_stop_sequence IS NULL THEN 'GTFS' ELSE 'JOIN' END AS schedule_joined,
  rank() OVER (PARTITION BY service_date, trip_id, pullout ORDER BY plan_at, tm_stop_sequence NULLS FIRST, gtfs_stop_sequence NULLS FIRST) AS stop_sequence FROM filled),
combined AS (SELECT * FROM (SELECT *, CASE WHEN stop_sequence = 1 THEN 'start' WHEN stop_sequence = max(stop_sequence) OVER (PARTITION BY service_date, trip_id) THEN 'end'
    WHEN coalesce(checkpoint_id, timepoint_abbr) IS NOT NULL THEN 'mid' END AS point_type, count(*) OVER (PARTITION BY service_date, trip_id, route_id, stop_sequence, tm_pullout_id) AS copies FROM ranked) WHERE copies = 1)"""


def _planned(user, seq):
    return (5 + user % 21) * 3600 + (user % 60) * 60 + seq * 600


def _schedules(t):
    """Two schedules of the same trips; a share of their departures differs."""
    p = positions(t)
    user, seq = F.col("user_id"), F.col("stop_sequence")
    day = F.unix_timestamp(F.col("service_date").cast("timestamp"))
    stripped = F.regexp_replace(F.regexp_replace("trip_id", r"-OL\d?", ""), r"_\d", "")
    gtfs = (
        p.filter(F.col("event_type") != "error")
        .select(
            "service_date", "trip_id", "stop_id", "route_id", "direction_id",
            seq.alias("gtfs_stop_sequence"),
            F.timestamp_seconds(day + _planned(user, seq)).alias("plan_stop_departure_dt"),
            F.concat(F.lit("b"), (user % 5).cast("string")).alias("block_id"),
            F.when(seq % 2 == 0, "chk").alias("checkpoint_id"),
        )
        .distinct()
        .withColumns(
            {
                "service_id": F.lit("s"), "route_pattern_id": F.lit("rp"), "route_pattern_typicality": F.lit(1),
                "direction": F.lit("d"), "direction_destination": F.concat(F.lit("to "), F.col("direction_id").cast("string")),
                "plan_stop_count": F.lit(1), "plan_start_time": F.lit(1), "plan_start_dt": F.col("service_date").cast("timestamp"),
            }
        )
    )
    late = F.when((user + seq) % 4 == 0, 30).otherwise(0)
    tm = (
        p.filter(F.col("event_type") != "view")
        .select(
            "service_date", stripped.alias("trip_id"), "stop_id", "route_id", "vehicle_label",
            seq.alias("tm_stop_sequence"),
            F.concat(F.lit("p"), (user % 3).cast("string")).alias("PULLOUT_ID"),
            F.timestamp_seconds(day + _planned(user, seq) + late).alias("tm_stop_departure_dt"),
            (user % 9).alias("pattern_id"),
            F.when(seq % 3 == 0, "tp").alias("timepoint_abbr"),
        )
        .distinct()
    )
    return cut_lineage(gtfs, "gtfs-schedule"), cut_lineage(tm, "tm-schedule")


@query(f"""
WITH {_SCHEDULES_SQL}
SELECT strftime(service_date, '%Y-%m-%d') AS service_date, trip_id, tm_pullout_id, stop_sequence, stop_id, gtfs_stop_sequence, tm_stop_sequence, block_id, direction_id, schedule_joined, point_type,
  epoch_us(plan_at) // 1000000 - 18000 - epoch_us(CAST(service_date AS TIMESTAMP)) // 1000000 AS plan_stop_departure_sam FROM combined
""")
def combined_schedule(t):
    found = bus.combined_schedule(*_schedules(t))
    return found.select(
        text(F.col("service_date")).alias("service_date"), "trip_id", "tm_pullout_id", "stop_sequence", "stop_id", "gtfs_stop_sequence",
        "tm_stop_sequence", "block_id", "direction_id", "schedule_joined", "point_type", "plan_stop_departure_sam",
    )


_JOINED_SQL = f"""{_SCHEDULES_SQL},
rt AS (SELECT *, regexp_replace(regexp_replace(trip_id, '-OL[0-9]?', ''), '_[0-9]', '') AS plain_trip FROM bus_events WHERE NOT (gtfs_stop_sequence = 1 AND departure IS NULL)),
logged AS (SELECT service_date, regexp_replace(regexp_replace(trip_id, '-OL[0-9]?', ''), '_[0-9]', '') AS trip_id, stop_sequence AS tm_stop_sequence, 'p' || user_id % 3 AS tm_pullout_id, vehicle_label,
  min(vehicle_timestamp) FILTER (event_type = 'click') AS tm_arrival, max(vehicle_timestamp) FILTER (event_type = 'purchase') AS tm_departure FROM positions WHERE event_type <> 'view' GROUP BY ALL),
pairs AS (SELECT coalesce(s.service_date, r.service_date) AS service_date, coalesce(s.trip_id, r.plain_trip) AS trip_id, s.tm_pullout_id, s.vehicle_label, r.vehicle_label AS vehicle_label_gtfs
  FROM (SELECT DISTINCT service_date, trip_id, tm_pullout_id, vehicle_label FROM combined) s FULL JOIN (SELECT DISTINCT service_date, plain_trip, vehicle_label FROM rt) r ON s.service_date = r.service_date AND s.trip_id = r.plain_trip),
matches AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY service_date, trip_id, vehicle_label_gtfs ORDER BY vehicle_label IS DISTINCT FROM vehicle_label_gtfs) AS r FROM pairs)
  WHERE r = 1 AND coalesce(vehicle_label, vehicle_label_gtfs) = vehicle_label_gtfs),
with_log AS (SELECT c.*, l.tm_arrival, l.tm_departure FROM combined c LEFT JOIN logged l ON c.service_date = l.service_date AND c.trip_id = l.trip_id AND c.tm_pullout_id = l.tm_pullout_id
  AND c.vehicle_label = l.vehicle_label AND c.tm_stop_sequence = l.tm_stop_sequence),
with_vehicle AS (SELECT w.*EXCLUDE (service_date, trip_id, tm_pullout_id, vehicle_label), coalesce(w.service_date, m.service_date) AS service_date, coalesce(w.trip_id, m.trip_id) AS trip_id,
    coalesce(w.tm_pullout_id, m.tm_pullout_id) AS tm_pullout_id, coalesce(w.vehicle_label, m.vehicle_label) AS vehicle_label0, m.vehicle_label_gtfs
  FROM with_log w FULL JOIN matches m ON w.service_date IS NOT DISTINCT FROM m.service_date AND w.trip_id IS NOT DISTINCT FROM m.trip_id AND w.tm_pullout_id IS NOT DISTINCT FROM m.tm_pullout_id
    AND w.vehicle_label IS NOT DISTINCT FROM m.vehicle_label),
seen AS (SELECT v.*, coalesce(v.vehicle_label0, v.vehicle_label_gtfs, '____') AS vehicle_label, rt.first_in_transit, rt.last_in_transit, rt.arrival, rt.departure, max(stop_sequence) OVER (PARTITION BY v.service_date, v.trip_id, v.tm_pullout_id) AS stop_count
  FROM with_vehicle v LEFT JOIN rt ON v.service_date = rt.service_date AND v.gtfs_stop_sequence = rt.gtfs_stop_sequence AND v.trip_id = rt.plain_trip AND v.vehicle_label_gtfs = rt.vehicle_label AND v.route_id = rt.route_id),
placed AS (SELECT *EXCLUDE (arrival), coalesce(arrival, CASE WHEN point_type = 'end' THEN last_in_transit END) AS arrival FROM seen),
checked AS (SELECT *, lag(tm_stop_sequence) OVER (PARTITION BY service_date, trip_id, vehicle_label, route_id, tm_pullout_id ORDER BY stop_sequence NULLS FIRST) AS prev_tm,
  count(*) OVER (PARTITION BY service_date, trip_id, route_id, vehicle_label, stop_sequence, tm_pullout_id) AS n_copies FROM placed),
bus AS (SELECT * FROM checked WHERE n_copies = 1 AND trip_id IS NOT NULL AND stop_id IS NOT NULL AND route_id IS NOT NULL AND tm_pullout_id IS NOT NULL AND stop_sequence IS NOT NULL AND trip_id NOT LIKE '%OL%' AND NOT ends_with(trip_id, '_1') AND NOT ends_with(trip_id, '_2')
  AND coalesce(tm_stop_sequence >= prev_tm, true) AND NOT coalesce(point_type = 'end' AND last_in_transit IS NOT NULL AND arrival IS NULL, false))"""


def _joined(t):
    gtfs, tm = _schedules(t)
    schedule = cut_lineage(bus.combined_schedule(gtfs, tm), "combined")
    p = positions(t)
    found = events.positions_to_events(filters.fold_incoming(p), stretch_seconds=60)
    seen = V.valid(cut_lineage(found, "rt"), V.first_stop_has_departure())
    stripped = F.regexp_replace(F.regexp_replace("trip_id", r"-OL\d?", ""), r"_\d", "")
    logged = (
        p.filter(F.col("event_type") != "view")
        .groupBy(
            "service_date", stripped.alias("trip_id"), F.col("stop_sequence").alias("tm_stop_sequence"),
            F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("tm_pullout_id"), "vehicle_label",
        )
        .agg(
            F.min(F.when(F.col("event_type") == "click", F.col("vehicle_timestamp"))).alias("tm_actual_arrival_dt"),
            F.max(F.when(F.col("event_type") == "purchase", F.col("vehicle_timestamp"))).alias("tm_actual_departure_dt"),
        )
        .withColumns({"tm_actual_arrival_time_sam": F.lit(0), "tm_actual_departure_time_sam": F.lit(0)})
    )
    operators = p.select("service_date", F.col("trip_id").alias("tm_trip_id"), F.col("vehicle_label").alias("tm_vehicle_label"), F.lit(1).alias("public_operator_id"))
    return bus.join_rt_to_schedule(schedule, seen, logged, operators)


@query(f"""
WITH {_JOINED_SQL}
SELECT strftime(service_date, '%Y-%m-%d') AS service_date, trip_id, tm_pullout_id, vehicle_label, stop_sequence, stop_id, epoch_us(tm_arrival) // 1000000 AS tm_arrival, epoch_us(tm_departure) // 1000000 AS tm_departure,
  epoch_us(arrival) // 1000000 AS gtfs_arrival, epoch_us(departure) // 1000000 AS gtfs_departure, stop_count FROM bus
""")
def rt_to_schedule(t):
    return _joined(t).select(
        text(F.col("service_date")).alias("service_date"), "trip_id", "tm_pullout_id", "vehicle_label", "stop_sequence", "stop_id",
        F.unix_timestamp("tm_actual_arrival_dt").alias("tm_arrival"),
        F.unix_timestamp("tm_actual_departure_dt").alias("tm_departure"),
        F.unix_timestamp("gtfs_arrival_dt").alias("gtfs_arrival"),
        F.unix_timestamp("gtfs_departure_dt").alias("gtfs_departure"),
        "stop_count",
    )


_METRICS_SQL = f"""{_JOINED_SQL},
o1 AS (SELECT *, CASE WHEN stop_sequence = 1 THEN coalesce(departure, tm_departure) ELSE least(tm_departure, departure) END AS d0 FROM bus),
o2 AS (SELECT *, least(greatest(arrival, tm_arrival), d0) AS a0 FROM o1),
o3 AS (SELECT *, CASE WHEN stop_sequence = stop_count THEN a0 ELSE d0 END AS d1 FROM o2),
o4 AS (SELECT *, max(greatest(d1, a0, last_in_transit)) OVER (PARTITION BY service_date, tm_pullout_id, trip_id, vehicle_label ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS floor_at FROM o3),
o5 AS (SELECT *, epoch_us(CASE WHEN d1 IS NOT NULL THEN greatest(d1, floor_at) END) // 1000000 AS dep, epoch_us(CASE WHEN a0 IS NOT NULL THEN greatest(a0, floor_at) END) // 1000000 AS arr,
  CASE WHEN d1 IS NOT NULL THEN greatest(d1, floor_at) END AS dep_dt, CASE WHEN a0 IS NOT NULL THEN greatest(a0, floor_at) END AS arr_dt, epoch_us(plan_at) // 1000000 AS plan FROM o4),
o6 AS (SELECT *, coalesce(arr, dep) - last_value(coalesce(dep, arr) IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS travel, dep - arr AS stopped, lag(arr_dt) OVER w AS prev_arr, lag(dep_dt) OVER w AS prev_dep,
  coalesce(dep, arr, plan) AS at0 FROM o5 WINDOW w AS (PARTITION BY service_date, tm_pullout_id, trip_id, vehicle_label ORDER BY stop_sequence)),
o7 AS (SELECT *, at0 - lag(at0) OVER (PARTITION BY service_date, stop_id, direction_id, route_id ORDER BY at0, trip_id, vehicle_label, tm_pullout_id, stop_sequence) AS h_route,
  sum(coalesce(travel, 0) + coalesce(stopped, 0)) OVER t = max(coalesce(dep, arr)) OVER t - min(coalesce(arr, dep)) OVER t AS total_ok FROM o6 WINDOW t AS (PARTITION BY service_date, trip_id, vehicle_label))"""


@query(f"""
WITH {_METRICS_SQL}
SELECT strftime(service_date, '%Y-%m-%d') AS service_date, trip_id, tm_pullout_id, vehicle_label, stop_sequence, arr AS arrival, dep AS departure, travel AS travel_time_seconds, stopped AS stopped_duration_seconds, h_route AS headway_seconds FROM o7
WHERE coalesce(arr_dt <= dep_dt, true) AND coalesce(arr_dt >= prev_arr, true) AND coalesce(dep_dt >= prev_dep, true) AND coalesce(h_route >= 0, true) AND coalesce(total_ok, true)
""")
def bus_performance(t):
    measured = bus.derived_metrics(cut_lineage(_joined(t), "joined"))
    return measured.select(
        text(F.col("service_date")).alias("service_date"), "trip_id", "tm_pullout_id", "vehicle_label", "stop_sequence",
        F.unix_timestamp("stop_arrival_dt").alias("arrival"), F.unix_timestamp("stop_departure_dt").alias("departure"),
        "travel_time_seconds", "stopped_duration_seconds", F.col("imputed_route_direction_headway_seconds").alias("headway_seconds"),
    )


# Rail ----------------------------------------------------------------------

_RAIL_COLUMNS = ("start_time", "vehicle_id", "vehicle_consist", "direction", "direction_destination", "static_start_time", "static_stop_count")


def _measured(t):
    m = _counted(t).drop("revenue", "first_stop_flag", "pm_trip_id")
    return m.select(
        "*",
        F.lit(True).alias("revenue"),
        F.lit(1).alias("static_version_key"),
        F.col("trip_id").alias("static_trip_id_guess"),
        F.lit(True).alias("first_last_station_match"),
        F.when(F.col("stop_sequence") > 1, F.col("stop_sequence")).alias("canonical_stop_sequence"),
        F.col("stop_sequence").alias("sync_stop_sequence"),
        *[F.lit(None).cast("long").alias(c) for c in ("travel_time_seconds", "dwell_time_seconds", "headway_trunk_seconds", "headway_branch_seconds")],
        *[F.lit(None).cast("long").alias(c) for c in _RAIL_COLUMNS],
    )


def _routes(t):
    names = positions(t).select("route_id").distinct()
    kind = F.when(F.col("route_id") == "39", 3).when(F.col("route_id") == "CR-Line", 2).otherwise(1)
    return names.select(F.lit(1).alias("static_version_key"), "route_id", kind.alias("route_type"))


@query(f"""
WITH {_COUNTED_SQL}, plan AS (SELECT trip_id, parent_station, min(k) AS scheduled_arrival_time FROM positions WHERE event_type = 'view' GROUP BY 1, 2)
SELECT c.service_date, c.trip_id, c.stop_sequence, c.parent_station, vp_move_timestamp AS move_timestamp, coalesce(vp_stop_timestamp, tu_stop_timestamp) AS stop_timestamp, stop_count, trunk_route_id, scheduled_arrival_time
FROM counted c LEFT JOIN plan p ON c.trip_id = p.trip_id AND c.parent_station = p.parent_station
WHERE route_id NOT IN ('39', 'CR-Line') AND (vp_move_timestamp IS NOT NULL OR vp_stop_timestamp IS NOT NULL)
""")
def daily_flat_table(t):
    scheduled = positions(t).filter(F.col("event_type") == "view").groupBy(F.lit(1).alias("static_version_key"), "trip_id", "parent_station").agg(
        F.min("k").alias("arrival_seconds"), F.min("k").alias("departure_seconds")
    ).withColumns({f"schedule_{c}": F.lit(None).cast("long") for c in ("travel_time_seconds", "headway_branch_seconds", "headway_trunk_seconds")})
    table = rail.daily_flat_table(_measured(t), scheduled, _routes(t))
    return table.select(
        "service_date", "trip_id", "stop_sequence", "parent_station", "move_timestamp", "stop_timestamp", "stop_count", "trunk_route_id", "scheduled_arrival_time"
    )


@query(f"""
WITH {_COUNTED_SQL}, linked AS (SELECT *, lag(stop_id) OVER w AS previous_stop_id, lead(vp_move_timestamp) OVER w AS next_move, lag(CASE WHEN stop_sequence > 1 THEN stop_sequence END) OVER w AS previous_canonical
  FROM counted WINDOW w AS (PARTITION BY service_date, route_id, trip_id ORDER BY stop_sequence, parent_station))
SELECT strftime(strptime(CAST(service_date AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS service_date, trip_id, stop_sequence, previous_stop_id, previous_canonical AS previous_canonical_stop_sequence, 'name ' || previous_stop_id AS previous_stop_name,
  next_move - 18000 - epoch_us(strptime(CAST(service_date AS VARCHAR), '%Y%m%d')) // 1000000 AS stop_departure_sec,
  strftime(make_timestamp((coalesce(vp_stop_timestamp, tu_stop_timestamp) - 18000) * 1000000), '%Y-%m-%d %H:%M:%S') AS stop_arrival_datetime
FROM linked WHERE route_id <> '39' AND (vp_move_timestamp IS NOT NULL OR vp_stop_timestamp IS NOT NULL)
""")
def rail_wide_table(t):
    stops = positions(t).select("stop_id").distinct().select(
        F.lit(1).alias("static_version_key"), "stop_id", F.concat(F.lit("name "), "stop_id").alias("stop_name")
    )
    wide = rail.rail_wide_table(_measured(t), stops, _routes(t), (0, 1, 2))
    return wide.select(
        text(F.col("service_date")).alias("service_date"), "trip_id", "stop_sequence", "previous_stop_id", "previous_canonical_stop_sequence", "previous_stop_name",
        "stop_departure_sec", F.date_format("stop_arrival_datetime", "yyyy-MM-dd HH:mm:ss").alias("stop_arrival_datetime"),
    )


_RAIL_METRICS_SQL = f"""{_COUNTED_SQL},
m AS (SELECT *EXCLUDE (revenue), true AS revenue FROM counted),
seen AS (SELECT *, row_number() OVER w AS rt_rank, lag(trip_id) OVER w IS NULL AS rt_first FROM m WHERE vp_move_timestamp IS NOT NULL OR vp_stop_timestamp IS NOT NULL WINDOW w AS (PARTITION BY service_date, route_id, trip_id ORDER BY stop_sequence, parent_station)),
calls AS (SELECT trip_id, parent_station, row_number() OVER w AS st_rank, lag(trip_id) OVER w IS NULL AS st_first FROM (SELECT trip_id, parent_station, min(stop_sequence) AS stop_sequence FROM positions WHERE event_type = 'view' GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY trip_id ORDER BY stop_sequence, parent_station)),
stops AS (SELECT s.*, coalesce(st_first, rt_first) AS first_flag, coalesce(vp_stop_timestamp, tu_stop_timestamp) AS stop_at FROM seen s LEFT JOIN calls c ON s.trip_id = c.trip_id AND s.parent_station = c.parent_station AND rt_rank >= st_rank),
dw AS (SELECT service_date, route_id, trip_id, parent_station, lead(vp_move_timestamp) OVER (PARTITION BY service_date, route_id, trip_id ORDER BY coalesce(vp_move_timestamp, stop_at) NULLS FIRST, parent_station) - stop_at AS d FROM stops WHERE NOT first_flag AND stop_count > 1),
lv AS (SELECT *, lead(vp_move_timestamp) OVER (PARTITION BY service_date, route_id, trip_id ORDER BY coalesce(vp_move_timestamp, vp_stop_timestamp) NULLS FIRST, stop_sequence, parent_station) AS nsm FROM seen WHERE stop_count > 1),
ht AS (SELECT service_date, route_id, trip_id, parent_station, nsm - lag(nsm) OVER (PARTITION BY parent_station, trunk_route_id, direction_id ORDER BY nsm NULLS FIRST, service_date, route_id, trip_id) AS h FROM lv)"""


@query(f"""
WITH {_RAIL_METRICS_SQL}
SELECT m.service_date, m.trip_id, m.parent_station, CASE WHEN s.stop_at > s.vp_move_timestamp THEN s.stop_at - s.vp_move_timestamp END AS travel_time_seconds, CASE WHEN d > 0 THEN d END AS dwell_time_seconds, CASE WHEN h > 0 THEN h END AS headway_trunk_seconds
FROM m LEFT JOIN stops s USING (service_date, route_id, trip_id, parent_station) LEFT JOIN dw USING (service_date, route_id, trip_id, parent_station) LEFT JOIN ht USING (service_date, route_id, trip_id, parent_station)
""")
def rail_metrics(t):
    wide = cut_lineage(_measured(t).drop("travel_time_seconds", "dwell_time_seconds", "headway_trunk_seconds", "headway_branch_seconds"), "wide")
    calls = positions(t).filter(F.col("event_type") == "view").groupBy(
        F.lit(1).alias("static_version_key"), F.col("trip_id").alias("static_trip_id"), "parent_station"
    ).agg(F.min("stop_sequence").alias("stop_sequence"))
    return rail.rail_metrics(wide, calls).select(
        "service_date", "trip_id", "parent_station", "travel_time_seconds", "dwell_time_seconds", "headway_trunk_seconds"
    )


# Alerts --------------------------------------------------------------------


@query("""
WITH fresh AS (SELECT * FROM orders WHERE o_orderstatus <> 'F')
SELECT o_orderkey AS id, 'about ' || o_orderpriority AS header, 'detail' AS cause_detail, strftime(timezone('America/New_York', timezone('UTC', o_orderdate)), '%Y-%m-%d %H:%M:%S') AS created,
  epoch_us(o_orderdate) // 1000000 AS period_start, r AS route_id, 'BOARD|RIDE' AS activities FROM fresh, (SELECT unnest(['1', '2']) AS r) WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'about ' || o_orderpriority, 'detail', strftime(timezone('America/New_York', timezone('UTC', o_orderdate)), '%Y-%m-%d %H:%M:%S'), NULL, NULL, NULL FROM fresh WHERE o_orderstatus = 'P'
""")
def alerts_job(t):
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    said = F.struct(F.array(F.struct(F.lit("es").alias("language"), F.lit("x").alias("text")),
                            F.struct(F.lit("en").alias("language"), F.concat(F.lit("about "), "o_orderpriority").alias("text"))).alias("translation"))
    nothing = F.lit(None).cast("array<struct<text: string, language: string>>")
    never = F.lit(None).cast("long")

    def entity(route):
        return F.struct(
            F.lit(route).alias("route_id"), F.lit(1).alias("route_type"), F.lit(0).alias("direction_id"), F.lit("s").alias("stop_id"),
            F.lit("f").alias("facility_id"), F.array(F.lit("BOARD"), F.lit("RIDE")).alias("activities"),
        )

    listed = F.col("o_orderstatus") != "P"
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"), "o_orderstatus",
        *[F.lit("c").alias(c) for c in ("cause", "effect", "effect_detail", "severity_level", "alert_lifecycle", "duration_certainty")],
        F.lit("detail").alias("cause_detail"), F.lit(3).alias("severity"),
        said.alias("header_text"),
        *[F.struct(nothing.alias("translation")).alias(c) for c in ("description_text", "service_effect_text", "timeframe_text", "recurrence_text")],
        at.alias("created_timestamp"), (at + 60).alias("last_modified_timestamp"), never.alias("last_push_notification_timestamp"), never.alias("closed_timestamp"),
        F.when(listed, F.array(F.struct(at.alias("start"), never.alias("end")))).alias("active_period"),
        F.when(listed, F.array(entity("1"), entity("2"), entity("2"))).alias("informed_entity"),
        nothing.alias("cause_detail_translation"), nothing.alias("effect_detail_translation"), at.alias("feed_timestamp"),
    )
    published = rows.filter(F.col("o_orderstatus") == "F")
    twice = rows.unionByName(rows).drop("o_orderstatus")
    return alerts.publish(twice, published).select(
        "id", F.col("header_text_translation_text").alias("header"), "cause_detail",
        F.date_format("created_datetime", "yyyy-MM-dd HH:mm:ss").alias("created"),
        F.col("active_period_start_timestamp").alias("period_start"), F.col("informed_entity_route_id").alias("route_id"),
        F.col("informed_entity_activities").alias("activities"),
    )


# Stop events ---------------------------------------------------------------


def _documents(t, where=None):
    """Feed snapshots: one document per event."""
    p = positions(t)
    if where is not None:
        p = p.filter(where)
    trip = F.struct(
        "trip_id", "route_id", F.col("direction_id").cast("int").alias("direction_id"), "start_time",
        F.date_format("service_date", "yyyyMMdd").alias("start_date"), F.lit(True).alias("revenue"),
    )
    vehicle = F.struct(
        trip.alias("trip"), F.struct(F.col("vehicle_id").alias("id"), F.col("vehicle_label").alias("label")).alias("vehicle"),
        F.when(F.col("event_type") != "error", F.col("stop_sequence")).alias("current_stop_sequence"), F.col("stop_id"), F.col("epoch").alias("timestamp"), "current_status",
    )
    return p.select(F.col("epoch").alias("published"), F.array(F.struct(F.col("event_id").cast("string").alias("id"), vehicle.alias("vehicle"))).alias("entity"))


_CANDIDATES_SQL = f"""{POSITIONS},
c AS (SELECT strftime(service_date, '%Y%m%d') AS start_date, route_id, trip_id, vehicle_id, stop_sequence, stop_id, epoch, CASE WHEN current_status = 'STOPPED_AT' THEN epoch END AS arrived, event_type FROM positions WHERE event_type <> 'error'),
cand AS (SELECT *, count(*) OVER (PARTITION BY start_date, route_id, trip_id, vehicle_id, stop_sequence) AS copies FROM c)"""


@query(f"""
WITH {_CANDIDATES_SQL}
SELECT start_date || '-' || route_id || '-' || trip_id || '-' || vehicle_id || '-' || stop_sequence AS id, epoch AS timestamp, arrived, stop_id FROM cand WHERE copies = 1
""")
def unnest_positions_stream(t):
    return stop_events.unnest_positions(_documents(t)).select("id", "timestamp", "arrived", "stop_id")


_STATE_SQL = f"""{POSITIONS},
lasts AS (SELECT strftime(service_date, '%Y%m%d') AS start_date, route_id, trip_id, vehicle_id, stop_sequence, direction_id, start_time, stop_id, epoch AS timestamp, CASE WHEN current_status = 'STOPPED_AT' THEN epoch END AS arrived, ts_rank, day_part
  FROM (SELECT *, CASE WHEN epoch < 1704888000 THEN 0 ELSE 1 END AS day_part, row_number() OVER (PARTITION BY service_date, route_id, trip_id, vehicle_id, stop_sequence, CASE WHEN epoch < 1704888000 THEN 0 ELSE 1 END ORDER BY epoch DESC, event_id DESC) AS ts_rank FROM positions) WHERE ts_rank = 1),
old AS (SELECT *, arrived AS ls FROM lasts WHERE day_part = 0 AND arrived IS NOT NULL), new AS (SELECT *, arrived AS ls FROM lasts WHERE day_part = 1),
kept AS (SELECT * FROM old WHERE 1704974400 - timestamp < 259200),
b AS (SELECT coalesce(o.start_date, n.start_date) AS start_date, coalesce(o.route_id, n.route_id) AS route_id, coalesce(o.trip_id, n.trip_id) AS trip_id, coalesce(o.vehicle_id, n.vehicle_id) AS vehicle_id, coalesce(o.stop_sequence, n.stop_sequence) AS stop_sequence,
    coalesce(o.arrived, n.arrived) AS arrived, o.ls AS o_ls, n.ls AS n_ls, o.timestamp AS o_ts FROM kept o FULL JOIN new n USING (start_date, route_id, trip_id, vehicle_id, stop_sequence)),
f AS (SELECT *, max(stop_sequence) OVER (PARTITION BY start_date, route_id, trip_id, vehicle_id) > stop_sequence AS passed FROM b),
r AS (SELECT start_date, route_id, trip_id, vehicle_id, stop_sequence, arrived, CASE WHEN passed THEN o_ls END AS departed, coalesce(CASE WHEN passed THEN 1704974400 END, o_ts, 1704974400) AS timestamp, coalesce(n_ls, o_ls) AS latest_stopped_timestamp FROM f)"""


def _state(t):
    """Newest record per key on each side of a cut in time."""
    p = positions(t).withColumn("late", F.col("epoch") >= 1704888000)
    at_stop = F.when(F.col("current_status") == "STOPPED_AT", F.col("epoch"))
    rows = p.select(
        F.date_format("service_date", "yyyyMMdd").alias("start_date"), "route_id", "trip_id", "vehicle_id", "stop_sequence", "direction_id", "start_time", "stop_id",
        F.lit(True).alias("revenue"), F.col("epoch").alias("timestamp"), at_stop.alias("arrived"), F.lit(None).cast("long").alias("departed"),
        at_stop.alias("latest_stopped_timestamp"), "late", "event_id",
    )
    newest = rows.groupBy(*stop_events.KEY, "late").agg(
        F.max_by(F.struct(*[c for c in rows.columns if c not in (*stop_events.KEY, "late")]), F.struct("timestamp", "event_id")).alias("r")
    ).select(*stop_events.KEY, "late", "r.*").withColumn("id", F.concat_ws("-", *stop_events.KEY))
    fields = stop_events.STATE.fieldNames()
    old = newest.filter(~F.col("late") & F.col("arrived").isNotNull()).select(*fields)
    return old, newest.filter("late").select(*fields)


@query(f"""
WITH {_STATE_SQL}
SELECT * FROM r WHERE arrived IS NOT NULL OR departed IS NOT NULL
""")
def update_stop_events(t):
    old, new = _state(t)
    updated = stop_events.update_stop_events(old, new, 1704974400, max_age=3 * 86400)
    return updated.select(*stop_events.KEY, "arrived", "departed", "timestamp", "latest_stopped_timestamp")


@query(f"""
WITH {POSITIONS}
SELECT event_id FROM positions WHERE 1705276800 - epoch < 7200
""")
def state_expiry(t):
    p = positions(t).select("event_id", F.col("epoch").alias("timestamp"))
    return stop_events.expire(p, 1705276800).select("event_id")


@query(f"""
WITH {POSITIONS},
c AS (SELECT strftime(service_date, '%Y%m%d') AS start_date, route_id, trip_id, vehicle_id, stop_sequence, epoch // 432000 AS d, CASE WHEN current_status = 'STOPPED_AT' THEN epoch END AS arrived,
  count(*) OVER (PARTITION BY service_date, route_id, trip_id, vehicle_id, stop_sequence, epoch // 432000) AS copies FROM positions WHERE event_type <> 'error'),
cand AS (SELECT * FROM c WHERE copies = 1), docs AS (SELECT epoch // 432000 AS d, max(epoch) AS t FROM positions GROUP BY 1),
firsts AS (SELECT start_date, route_id, trip_id, vehicle_id, stop_sequence, min(d) AS a, arg_min(arrived, d) AS arrived FROM cand WHERE arrived IS NOT NULL GROUP BY ALL),
moves AS (SELECT start_date, route_id, trip_id, vehicle_id, d, max(stop_sequence) AS m FROM cand GROUP BY ALL),
kept AS (SELECT start_date, route_id, trip_id, vehicle_id, docs.d, max(stop_sequence) AS m FROM firsts JOIN docs ON docs.d > a GROUP BY ALL),
passed AS (SELECT f.start_date, f.route_id, f.trip_id, f.vehicle_id, f.stop_sequence, min(k.d) AS df, max(k.d) AS dl FROM firsts f JOIN kept k ON k.start_date = f.start_date AND k.route_id = f.route_id AND k.trip_id = f.trip_id AND k.vehicle_id = f.vehicle_id AND k.d > f.a
  LEFT JOIN moves m ON m.start_date = k.start_date AND m.route_id = k.route_id AND m.trip_id = k.trip_id AND m.vehicle_id = k.vehicle_id AND m.d = k.d WHERE greatest(k.m, coalesce(m.m, k.m)) > f.stop_sequence GROUP BY ALL)
SELECT f.start_date, f.route_id, f.trip_id, f.stop_sequence, f.arrived, (SELECT arg_max(x.arrived, x.d) FROM cand x WHERE x.start_date = f.start_date AND x.route_id = f.route_id AND x.trip_id = f.trip_id AND x.vehicle_id = f.vehicle_id AND x.stop_sequence = f.stop_sequence AND x.arrived IS NOT NULL AND x.d < p.dl) AS departed,
  coalesce(pd.t, ad.t) AS timestamp FROM firsts f LEFT JOIN passed p USING (start_date, route_id, trip_id, vehicle_id, stop_sequence) JOIN docs ad ON ad.d = f.a LEFT JOIN docs pd ON pd.d = p.df
""")
def stop_event_loop(t):
    """Documents of several snapshots in one micro-batch; the SQL replays the snapshots."""
    folder = scratch_path(t.spark, "documents")
    found = _documents(t).withColumn("snapshot", F.floor(F.col("published") / 432_000))
    times = found.groupBy("snapshot").agg(F.max("published").alias("at"))
    docs = found.join(times, "snapshot").select(
        F.to_json(F.struct(F.struct(F.col("at").alias("timestamp")).alias("header"), F.col("entity"))).alias("value")
    )
    docs.write.text(folder)
    state = VersionedTable(t.spark, scratch_path(t.spark, "stop-events"), stop_events.STATE)
    lines = t.spark.readStream.format("text").load(folder).select(F.col("value").alias("document"))
    run = streams.stop_event_loop(t.spark, lines, state, scratch_path(t.spark, "stop-events-progress"), max_age=10**9)
    run.awaitTermination()
    return state.latest().select("start_date", "route_id", "trip_id", "stop_sequence", "arrived", "departed", "timestamp")


@query(f"""
WITH {POSITIONS}
SELECT trip_id, stop_sequence, count(*) > 0 AS seen FROM positions GROUP BY 1, 2
""")
def late_and_out_of_order(t):
    """Stream dedup under a watermark; the whole table is one batch, so one row per payload stays."""
    source = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)

    class Streamed:
        events = source

    stream = positions(Streamed()).select("trip_id", "stop_sequence", "vehicle_timestamp")
    out = scratch_path(t.spark, "deduplicated")
    deduplicated = streams.late_deduplicated(stream, "vehicle_timestamp", ["trip_id", "stop_sequence"])
    run = deduplicated.writeStream.format("parquet").option("checkpointLocation", scratch_path(t.spark, "dedup-progress")).trigger(availableNow=True).start(out)
    run.awaitTermination()
    return t.spark.read.parquet(out).select("trip_id", "stop_sequence", F.lit(True).alias("seen"))


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, trip_id, parent_station, vp_move_timestamp, vp_stop_timestamp, tu_stop_timestamp, count(*) OVER (PARTITION BY service_date, trip_id) AS trip_stops FROM rail_events
""")
def incremental_change_loop(t):
    """Rail events in several micro-batches, moves first, upserted by date; trips of touched dates counted anew."""
    keys = ["service_date", "trip_id", "parent_station"]
    e = rail_events(t).select(*keys, "stop_sequence", "vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp")
    folder = scratch_path(t.spark, "changes")
    moves = e.withColumns({"vp_stop_timestamp": F.lit(None).cast("long"), "tu_stop_timestamp": F.lit(None).cast("long")})
    moves.coalesce(1).write.parquet(f"{folder}/part=1")
    # moves come again: a batch of their own and one that all events share give the same table
    moves.unionByName(e).repartition(2).write.parquet(f"{folder}/part=2")
    state = DatedTable(t.spark, scratch_path(t.spark, "rail-events"), e.schema, "service_date")
    counted = T.StructType([e.schema["service_date"], e.schema["trip_id"], T.StructField("trip_stops", T.LongType())])
    trips_ = DatedTable(t.spark, scratch_path(t.spark, "rail-trips"), counted, "service_date")

    def recompute(rows, dates):
        fresh = rows.groupBy("service_date", "trip_id").agg(F.count("*").alias("trip_stops"))
        trips_.write(fresh, trips_.next_number(), dates)

    arriving = t.spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/part=*")
    run = streams.incremental_change_loop(t.spark, arriving, state, keys, recompute, scratch_path(t.spark, "rail-progress"))
    run.awaitTermination()
    columns = [*keys, "vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp", "trip_stops"]
    return state.latest().join(trips_.latest(), ["service_date", "trip_id"]).select(*columns)


@query("""
SELECT event_id, (event_id + 1) * 60 - epoch_us(ts) // 1000000 AS lag_seconds FROM events
""")
def freshness_lag(t):
    from tramline.functions.rows import lag_seconds

    return t.events.select(
        "event_id", lag_seconds((F.col("event_id") + 1) * 60, F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("lag_seconds")
    )




# Feeds from files to events -------------------------------------------------

_FEED_NAMES = (
    "RT_VEHICLE_POSITIONS", "RT_TRIP_UPDATES", "RT_ALERTS", "BUS_VEHICLE_POSITIONS", "BUS_TRIP_UPDATES",
    "DEV_GREEN_RT_TRIP_UPDATES", "DEV_GREEN_RT_VEHICLE_POSITIONS",
)


_FILE_IDS = 500_000


def _feed_files(t, name, folder):
    """A document for every week and tenth of the events, in a file for each 500,000 event ids; ``name`` tells an event's feed."""
    p = positions(t).withColumn("feed", name)
    trip = F.struct(
        "trip_id", "route_id", F.col("direction_id").cast("int").alias("direction_id"), "start_time",
        F.date_format("service_date", "yyyyMMdd").alias("start_date"), F.lit(True).alias("revenue"),
    )
    cars = F.array(F.struct(F.col("vehicle_label").alias("label")), F.struct(F.lit("x").alias("label")))
    vehicle = F.struct(F.col("vehicle_id").alias("id"), F.col("vehicle_label").alias("label"), cars.alias("consist"))
    place = F.struct(F.col("stop_sequence").alias("stop_sequence"), "stop_id", F.struct((F.col("epoch") + 60).alias("time")).alias("arrival"))
    position = F.struct(
        trip.alias("trip"), vehicle.alias("vehicle"), F.struct("latitude", "longitude").alias("position"),
        F.col("stop_sequence").alias("current_stop_sequence"), "stop_id", F.col("epoch").alias("timestamp"), "current_status",
    )
    update = F.struct(trip.alias("trip"), vehicle.alias("vehicle"), F.array(place).alias("stop_time_update"), F.col("epoch").alias("timestamp"))
    alert = F.struct(F.col("route_id").alias("cause"), F.lit("DELAY").alias("effect"), F.col("stop_sequence").cast("int").alias("severity"))
    entity = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.when(F.col("feed").endswith("POSITIONS"), position).alias("vehicle"),
        F.when(F.col("feed").endswith("UPDATES"), update).alias("trip_update"),
        F.when(F.col("feed").endswith("ALERTS"), alert).alias("alert"),
    )
    part = F.concat_ws("-", F.date_format("service_date", "yyyyMMdd"), (F.col("event_id") % 10).cast("string"))
    # a document is cut by event ids into files of bounded size, which all bear its time
    stamps = p.groupBy("feed", part.alias("part")).agg(F.max("epoch").alias("timestamp"))
    cut = F.floor(F.col("event_id") / _FILE_IDS).cast("string")
    pieces = p.groupBy("feed", part.alias("part"), F.concat_ws("-", part, cut).alias("doc")).agg(F.collect_list(entity).alias("entity"))
    docs = pieces.join(F.broadcast(stamps), ["feed", "part"])
    text_ = F.to_json(F.struct(F.struct("timestamp").alias("header"), F.col("entity")))
    docs.select("feed", "doc", text_.alias("value")).repartition("feed", "doc").write.partitionBy("feed", "doc").text(folder)


@query(f"""
WITH {POSITIONS}, named AS (SELECT *, ['{"', '".join(_FEED_NAMES)}'][event_id % 7 + 1] AS feed FROM positions)
SELECT feed, CAST(event_id AS VARCHAR) AS id, route_id AS value, max(epoch) OVER (PARTITION BY feed, service_date, event_id % 10) AS feed_timestamp FROM named
""")
def feeds_ingested(t):
    """All seven feeds, from written files into their tables."""
    folder = scratch_path(t.spark, "feed-files")
    _feed_files(t, F.element_at(F.array(*[F.lit(n) for n in _FEED_NAMES]), (F.col("event_id") % 7 + 1).cast("int")), folder)
    found = []
    for name in _FEED_NAMES:
        table = scratch_path(t.spark, name.lower())
        ingest.ingest_feed(t.spark, feeds.read_documents(t.spark, f"{folder}/feed={name}/*"), name, table)
        value = F.col("`alert.cause`" if name == "RT_ALERTS" else f"`{feeds.FEEDS[name].sort}`")
        found.append(t.spark.read.parquet(table).select(F.lit(name).alias("feed"), "id", value.alias("value"), "feed_timestamp"))
    return reduce(DataFrame.unionByName, found)


@query(f"""
WITH {POSITIONS}, rail AS (SELECT *, CAST(strftime(service_date, '%Y%m%d') AS BIGINT) AS day, coalesce('p' || nullif(CAST(stop_id AS BIGINT) % 4, 3), stop_id) AS station FROM positions
  WHERE route_id IN ('Red', 'Orange', 'Blue', 'Green-B', 'Green-C', 'Green-D', 'Green-E', 'Mattapan'))
SELECT day AS service_date, route_id, trip_id, station AS parent_station, min(epoch) FILTER (current_status <> 'STOPPED_AT') AS vp_move_timestamp,
  min(epoch) FILTER (current_status = 'STOPPED_AT') AS vp_stop_timestamp, min(vehicle_label) || '|x' AS vehicle_consist, CAST(7 AS BIGINT) AS static_version_key
FROM rail GROUP BY ALL
""")
def feed_position_events(t):
    """Position documents -> stored feed -> the analysis' columns -> rail events."""
    folder, table = scratch_path(t.spark, "feed-files"), scratch_path(t.spark, "positions")
    _feed_files(t, F.lit("RT_VEHICLE_POSITIONS"), folder)
    ingest.ingest_feed(t.spark, feeds.read_documents(t.spark, f"{folder}/feed=*/*"), "RT_VEHICLE_POSITIONS", table)
    rows = feeds.rail_position_rows(t.spark.read.parquet(table))
    version = F.lit(7).cast("long").alias("static_version_key")
    days = [F.lit(d).cast("long") for d in (20200101, 20291231, 20200101)]
    info = t.region.limit(1).select(
        version, days[0].alias("feed_start_date"), days[1].alias("feed_end_date"), days[2].alias("feed_active_date"), days[2].alias("created_on")
    )
    number = F.col("stop_id").cast("long") % 4
    stops = rows.select("stop_id").distinct().select(
        version, "stop_id", F.when(number < 3, F.concat(F.lit("p"), number.cast("string"))).alias("parent_station")
    )
    found = rail.position_events(rows, list(filters.SUBWAY_ROUTES), info, stops)
    return found.select("service_date", "route_id", "trip_id", "parent_station", "vp_move_timestamp", "vp_stop_timestamp", "vehicle_consist", "static_version_key")
