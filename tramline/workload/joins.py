"""Joins (section 2.4 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators import aggregates, calendar, joins, metrics
from tramline.workload.registry import query
from tramline.workload.scans import feed_versions, _FEEDS_SQL
from tramline.workload.standins import (
    POSITIONS,
    RAIL_EVENTS,
    STOP_TIMES,
    TRIPS,
    positions,
    rail_events,
    stop_times,
    text,
    trips,
)
from tramline.functions import texts, times


@query(f"""
WITH {TRIPS}
SELECT t.trip_id, t.route_id, c.c_mktsegment AS pattern, n.n_name AS direction, r.r_name AS line
FROM trips t JOIN customer c ON t.block_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  AND r.r_regionkey <> t.direction_id
""")
def inner_chain(t):
    blocks = t.customer.select(F.col("c_custkey").alias("block_id"), "c_mktsegment", "c_nationkey")
    lines = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("direction"), F.col("r_name").alias("line"), "r_regionkey"
    )
    chained = joins.enrich(joins.enrich(trips(t), blocks, ["block_id"], "inner"), lines, ["c_nationkey"], "inner")
    return chained.filter(F.col("r_regionkey") != F.col("direction_id")).select(
        "trip_id", "route_id", F.col("c_mktsegment").alias("pattern"), "direction", "line"
    )


@query(f"""
WITH {STOP_TIMES}
SELECT s.trip_id, s.stop_sequence, s.part, p.s_name AS stop_name, c.stop_count, c.start_time
FROM stop_times s LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) p ON s.stop_id = p.s_suppkey
LEFT JOIN (SELECT trip_id, count(*) AS stop_count, min(arrival_seconds) AS start_time FROM stop_times GROUP BY 1) c USING (trip_id)
""")
def left_enrich(t):
    stops = t.supplier.filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("stop_id"), F.col("s_name").alias("stop_name"))
    s = stop_times(t)
    counts = aggregates.trip_stop_counts(s, ["trip_id"], "arrival_seconds")
    joined = joins.enrich(joins.enrich(s, stops, ["stop_id"]), counts, ["trip_id"])
    return joined.select("trip_id", "stop_sequence", "part", "stop_name", "stop_count", "start_time")


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, o_orderpriority AS trip, s_name AS geo_node, p_name AS time_point,
  CASE WHEN p_size < 30 THEN p_brand END AS waiver, n_name AS vehicle, ltrim(lpad(CAST(l_suppkey AS VARCHAR), 6, '0'), '0') AS route
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN nation ON s_nationkey = n_nationkey
""")
def av_star_left(t):
    crossings = t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("long"), "l_partkey", "l_suppkey",
        F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("ROUTE_ABBR"),
    )
    dims = [
        (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("trip")), ["l_orderkey"]),
        (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("geo_node"), "s_nationkey"), ["l_suppkey"]),
        (t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("time_point"),
                       F.when(F.col("p_size") < 30, F.col("p_brand")).alias("waiver")), ["l_partkey"]),
        (t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("vehicle")), ["s_nationkey"]),
    ]
    for dim, keys in dims:
        crossings = joins.enrich(crossings, dim.distinct(), keys)
    return crossings.select(
        "l_orderkey", "l_linenumber", "l_partkey", "trip", "geo_node", "time_point", "waiver", "vehicle",
        texts.strip_leading_zeros(F.col("ROUTE_ABBR")).alias("route"),
    )


_WORK_SQL = """work AS (SELECT o_orderkey AS work_piece_id, o_custkey AS block_id, epoch_us(o_orderdate) // 1000000 AS begin_time,
    epoch_us(o_orderdate) // 1000000 + (o_orderkey % 200) * 86400 AS end_time FROM orders),
trip_ends AS (SELECT l_orderkey AS trip_key, l_partkey AS trip_part, o_custkey AS block_id, epoch_us(l_shipdate) // 1000000 AS trip_end_time FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def work_pieces(t):
    begin = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    return t.orders.select(
        F.col("o_orderkey").alias("work_piece_id"),
        F.col("o_custkey").alias("block_id"),
        begin.alias("begin_time"),
        (begin + (F.col("o_orderkey") % 200) * 86400).alias("end_time"),
    )


def trip_ends(t):
    blocks = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("block_id"))
    return t.lineitem.join(blocks, "l_orderkey").select(
        F.col("l_orderkey").alias("trip_key"),
        F.col("l_partkey").alias("trip_part"),
        "block_id",
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("trip_end_time"),
    )


@query(f"""
WITH {_WORK_SQL}
SELECT work_piece_id, trip_key, trip_part, trip_end_time FROM work JOIN trip_ends USING (block_id) WHERE begin_time < trip_end_time AND trip_end_time <= end_time
""")
def interval_join_workpiece(t):
    found = joins.interval_join(
        trip_ends(t), work_pieces(t), ["block_id"], "trip_end_time", "begin_time", "end_time", 30 * 86400
    )
    return found.select("work_piece_id", "trip_key", "trip_part", "trip_end_time")


@query(f"""
WITH {_WORK_SQL}
SELECT w.work_piece_id, e.trip_key, e.trip_part, c.c_name AS operator, n.n_name AS vehicle,
  strftime(timezone('UTC', timezone('America/New_York', o.o_orderdate + INTERVAL 1 SECOND * (21600 + o.o_orderkey % 3600))), '%Y-%m-%d %H:%M:%S') AS logon_time
FROM work w JOIN orders o ON w.work_piece_id = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey AND c.c_acctbal > 0
LEFT JOIN (SELECT work_piece_id, trip_key, trip_part FROM work JOIN trip_ends USING (block_id) WHERE begin_time < trip_end_time AND trip_end_time <= end_time) e
  ON w.work_piece_id = e.work_piece_id
""")
def operator_assignment(t):
    from tramline.plans.bus import operator_assignment as assign

    static = joins.interval_join(
        trip_ends(t), work_pieces(t), ["block_id"], "trip_end_time", "begin_time", "end_time", 30 * 86400
    ).select(
        F.col("work_piece_id").alias("WORK_PIECE_ID"), F.col("block_id").alias("BLOCK_ABBR"), F.lit(0).cast("long").alias("RUN_ID"),
        F.lit("r").alias("RUN_DESIGNATOR"), F.col("trip_key").alias("TRIP_SERIAL_NUMBER"), "trip_part",
    )
    daily = t.orders.select(
        F.col("o_orderkey").alias("WORK_PIECE_ID"),
        F.concat(F.lit("1"), F.date_format("o_orderdate", "yyyyMMdd")).cast("long").alias("CALENDAR_ID"),
        F.col("o_custkey").alias("CURRENT_OPERATOR_ID"),
        F.lit(0).cast("long").alias("RUN_ID"),
        F.col("o_custkey").alias("CURRENT_VEHICLE_ID"),
        (21600 + F.col("o_orderkey") % 3600).alias("ACTUAL_LOGON_TIME"),
        F.lit(None).cast("long").alias("ACTUAL_LOGOFF_TIME"),
    )
    operators = t.customer.select(F.col("c_custkey").alias("OPERATOR_ID"), F.col("c_name").alias("ONBOARD_LOGON_ID"))
    vehicles = t.customer.filter(F.col("c_acctbal") > 0).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("VEHICLE_ID"), F.col("n_name").alias("PROPERTY_TAG")
    )
    assigned = assign(daily, operators, vehicles, static, keep=("WORK_PIECE_ID", "trip_part"))
    return assigned.select(
        F.col("WORK_PIECE_ID").alias("work_piece_id"), F.col("tm_trip_id").cast("long").alias("trip_key"), "trip_part",
        F.col("operator_badge_number").alias("operator"), F.col("tm_vehicle_label").alias("vehicle"),
        F.date_format("logon_time", "yyyy-MM-dd HH:mm:ss").alias("logon_time"),
    )


_SIDES_SQL = f"""{POSITIONS},
g AS (SELECT service_date, trip_id, stop_sequence, stop_id, min(epoch) AS dep, any_value(route_id) AS route_id FROM positions WHERE event_type <> 'error' GROUP BY ALL),
m AS (SELECT service_date, trip_id, stop_sequence, stop_id, max(epoch) AS dep, any_value(vehicle_label) AS label FROM positions WHERE event_type <> 'view' GROUP BY ALL)"""

_KEYS = ["service_date", "trip_id", "stop_sequence", "stop_id"]


def _gtfs_side(t):
    return positions(t).filter(F.col("event_type") != "error").groupBy(*_KEYS).agg(
        F.min("epoch").alias("dep"), F.max("route_id").alias("route_id")
    )


def _tm_side(t):
    return positions(t).filter(F.col("event_type") != "view").groupBy(*_KEYS).agg(
        F.max("epoch").alias("dep"), F.max("vehicle_label").alias("label")
    )


@query(f"""
WITH {_SIDES_SQL}
SELECT strftime(coalesce(g.service_date, m.service_date), '%Y-%m-%d') AS service_date, coalesce(g.trip_id, m.trip_id) AS trip_id,
  coalesce(g.stop_sequence, m.stop_sequence) AS stop_sequence, g.dep AS dep, m.dep AS dep_tm, label
FROM g FULL JOIN m ON g.service_date = m.service_date AND g.trip_id = m.trip_id AND g.stop_sequence = m.stop_sequence AND g.stop_id = m.stop_id
""")
def full_outer_coalesce(t):
    both = joins.full_outer_coalesce(_gtfs_side(t), _tm_side(t), _KEYS, suffix="_tm")
    return both.select(text(F.col("service_date")).alias("service_date"), "trip_id", "stop_sequence", "dep", "dep_tm", "label")


@query(f"""
WITH {TRIPS}
SELECT o.trip_id, o.route_id, e.pieces FROM trips o JOIN (SELECT l_orderkey, count(*) AS pieces FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) e ON o.trip_id = e.l_orderkey
UNION ALL SELECT trip_id, route_id, NULL FROM trips WHERE trip_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def semi_anti_split_union(t):
    known = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("trip_id"))
    pieces = known.groupBy("trip_id").agg(F.count(F.lit(1)).alias("pieces"))
    all_trips = trips(t).select("trip_id", "route_id")
    enriched = joins.enrich(all_trips.join(known, "trip_id", "left_semi"), pieces, ["trip_id"], "inner")
    return joins.split_enrich_union(all_trips, known, ["trip_id"], enriched)


_VEHICLES_SQL = f"""{POSITIONS},
sched AS (SELECT DISTINCT trip_id, 'p' || (stop_sequence % 2) AS tm_pullout_id, CASE WHEN event_type = 'view' THEN NULL WHEN k < 60 THEN vehicle_label ELSE 'x' || k END AS vehicle_label
  FROM positions WHERE event_type IN ('view', 'click')),
rt AS (SELECT DISTINCT trip_id, CASE WHEN k < 40 THEN vehicle_label ELSE 'z' || k END AS vehicle_label FROM positions WHERE event_type <> 'view' AND k < 70)"""


def _vehicle_sides(t):
    p = positions(t)
    k = F.col("k")
    sched = p.filter(F.col("event_type").isin("view", "click")).select(
        "trip_id",
        F.concat(F.lit("p"), (F.col("stop_sequence") % 2).cast("string")).alias("tm_pullout_id"),
        F.when(F.col("event_type") == "view", None).when(k < 60, F.col("vehicle_label")).otherwise(F.concat(F.lit("x"), k.cast("string"))).alias("vehicle_label"),
    )
    rt = p.filter((F.col("event_type") != "view") & (k < 70)).select(
        "trip_id", F.when(k < 40, F.col("vehicle_label")).otherwise(F.concat(F.lit("z"), k.cast("string"))).alias("vehicle_label")
    )
    return sched, rt


@query(f"""
WITH {_VEHICLES_SQL},
paired AS (SELECT coalesce(s.trip_id, r.trip_id) AS trip_id, tm_pullout_id, s.vehicle_label, r.vehicle_label AS vehicle_label_gtfs FROM sched s FULL JOIN rt r ON s.trip_id = r.trip_id),
ranked AS (SELECT *, rank() OVER (PARTITION BY trip_id, vehicle_label_gtfs ORDER BY vehicle_label IS DISTINCT FROM vehicle_label_gtfs) AS vehicle_match FROM paired)
SELECT trip_id, tm_pullout_id, vehicle_label, vehicle_label_gtfs FROM ranked WHERE vehicle_match = 1 AND coalesce(vehicle_label, vehicle_label_gtfs) = vehicle_label_gtfs
""")
def trip_vehicle_match(t):
    return joins.trip_vehicle_match(*_vehicle_sides(t))


@query(f"""
WITH {RAIL_EVENTS}
SELECT a.service_date, a.pm_trip_id, a.stop_sequence, a.vp_stop_timestamp, b.n
FROM rail_events a JOIN (SELECT service_date, vp_stop_timestamp, vehicle_label, count(*) AS n FROM rail_events GROUP BY ALL) b
  ON a.service_date = b.service_date AND a.vp_stop_timestamp IS NOT DISTINCT FROM b.vp_stop_timestamp AND a.vehicle_label IS NOT DISTINCT FROM b.vehicle_label
""")
def null_safe_join(t):
    e = rail_events(t).select("service_date", "pm_trip_id", "stop_sequence", "vp_stop_timestamp", "vehicle_label")
    keys = ["service_date", "vp_stop_timestamp", "vehicle_label"]
    counts = e.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return joins.null_safe_join(e, counts, keys).select("service_date", "pm_trip_id", "stop_sequence", "vp_stop_timestamp", "n")


_ASOF_SQL = """rt AS (SELECT event_id, user_id % 10 AS route_id, event_id % 2 AS direction_id, epoch_us(ts) // 1000000 AS start_time FROM events WHERE event_type = 'purchase'),
st AS (SELECT user_id % 10 AS route_id, event_id % 2 AS direction_id, epoch_us(ts) // 1000000 AS static_start_time, min(event_id) AS static_trip_id
  FROM events WHERE event_type = 'view' GROUP BY ALL),
both_sides AS (SELECT rt.*, b.static_trip_id AS b_id, b.static_start_time AS b_at, a.static_trip_id AS a_id, a.static_start_time AS a_at FROM rt
  ASOF LEFT JOIN st b ON rt.route_id = b.route_id AND rt.direction_id = b.direction_id AND rt.start_time >= b.static_start_time
  ASOF LEFT JOIN st a ON rt.route_id = a.route_id AND rt.direction_id = a.direction_id AND rt.start_time < a.static_start_time),
nearest AS (SELECT event_id, start_time, CASE WHEN b_at IS NULL OR a_at - start_time < start_time - b_at THEN a_id ELSE b_id END AS static_trip_id,
  CASE WHEN b_at IS NULL OR a_at - start_time < start_time - b_at THEN a_at ELSE b_at END AS static_start_time FROM both_sides)"""


def _asof_sides(t):
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    keys = [(F.col("user_id") % 10).alias("route_id"), (F.col("event_id") % 2).alias("direction_id")]
    rt = t.events.filter(F.col("event_type") == "purchase").select("event_id", *keys, at.alias("start_time"))
    st = t.events.filter(F.col("event_type") == "view").select(*keys, at.alias("static_start_time"), F.col("event_id").alias("static_trip_id"))
    return rt, st


@query(f"""
WITH {_ASOF_SQL}
SELECT event_id, start_time, static_trip_id, static_start_time FROM nearest
""")
def asof_nearest(t):
    rt, st = _asof_sides(t)
    found = joins.asof_nearest(rt, st, ["route_id", "direction_id"], "start_time", "static_start_time", "static_trip_id", 60)
    return found.select("event_id", "start_time", "static_trip_id", "static_start_time")


@query(f"""
WITH {_ASOF_SQL}
SELECT event_id, CASE WHEN abs(start_time - static_start_time) <= 3600 THEN static_trip_id END AS static_trip_id,
  CASE WHEN abs(start_time - static_start_time) <= 3600 THEN start_time - static_start_time END AS diff FROM nearest
""")
def asof_investigate(t):
    rt, st = _asof_sides(t)
    found = joins.asof_nearest(
        rt, st, ["route_id", "direction_id"], "start_time", "static_start_time", "static_trip_id", 60, tolerance=3600
    )
    return found.select("event_id", "static_trip_id", (F.col("start_time") - F.col("static_start_time")).alias("diff"))


@query(f"""
WITH {STOP_TIMES}, {TRIPS}
SELECT DISTINCT l_orderkey AS pm_trip_id, true AS first_last_station_match, c.n AS static_stop_count, b.start_time AS static_start_time FROM
  (SELECT l_orderkey, CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS BIGINT) END AS start_time FROM lineitem WHERE l_returnflag = 'A') b
  JOIN trips t ON b.l_orderkey = t.trip_id JOIN (SELECT trip_id, count(stop_sequence) AS n FROM stop_times GROUP BY 1) c ON c.trip_id = b.l_orderkey WHERE b.start_time IS NOT NULL
""")
def exact_trip_match(t):
    from tramline.plans.rail import exact_trip_match as match

    rt = t.lineitem.filter(F.col("l_returnflag") == "A").select(
        F.col("l_orderkey").alias("pm_trip_id"), F.col("l_orderkey").alias("trip_id"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber").cast("long")).alias("start_time"),
        F.lit(1).alias("static_version_key"),
    )
    static_trips = trips(t).select("trip_id", F.lit(1).alias("static_version_key"))
    static_stops = stop_times(t).withColumn("static_version_key", F.lit(1))
    return match(rt, static_trips, static_stops).select(
        "pm_trip_id", "first_last_station_match", "static_stop_count", "static_start_time"
    )


_THETA_SQL = f"""{RAIL_EVENTS},
rt AS (SELECT *, rank() OVER (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence) AS rt_rank FROM rail_events),
st AS (SELECT user_id AS trip, parent_station, min(static_rank) AS static_rank FROM (SELECT user_id, parent_station, rank() OVER (PARTITION BY user_id ORDER BY stop_sequence DESC) AS static_rank
  FROM (SELECT DISTINCT user_id, parent_station, stop_sequence FROM positions WHERE event_type = 'view')) GROUP BY ALL),
matched AS (SELECT service_date, pm_trip_id, rt.parent_station, rt_rank, static_rank, row_number() OVER (PARTITION BY service_date, pm_trip_id, rt.parent_station
  ORDER BY static_rank NULLS LAST, rt_rank, stop_sequence) AS n FROM rt LEFT JOIN st ON rt.pm_trip_id = st.trip AND rt.parent_station = st.parent_station AND rt_rank >= static_rank)"""


@query(f"""
WITH {_THETA_SQL}
SELECT service_date, pm_trip_id, parent_station, rt_rank, static_rank FROM matched WHERE n = 1
""")
def outer_theta_distinct_on(t):
    events = rail_events(t).select("service_date", "pm_trip_id", "parent_station", "stop_sequence")
    rt = metrics.first_last_rank(events, ["service_date", "pm_trip_id"], ["stop_sequence"], "rt").withColumns(
        {"static_trip_id_guess": F.col("pm_trip_id"), "static_version_key": F.lit(1)}
    )
    calls = positions(t).filter(F.col("event_type") == "view").select(
        F.col("user_id").alias("static_trip_id"), "parent_station", (-F.col("stop_sequence")).alias("_seq")
    ).distinct()
    static = metrics.first_last_rank(calls, ["static_trip_id"], ["_seq"], "static").select(
        "static_trip_id", "parent_station", "static_stop_rank", F.lit(1).alias("static_version_key")
    )
    return joins.match_static_stop(rt, static).select(
        "service_date", "pm_trip_id", "parent_station", F.col("rt_stop_rank").alias("rt_rank"), F.col("static_stop_rank").alias("static_rank")
    )


@query("""
SELECT o_orderkey, n_name AS direction, r_name AS direction_destination FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def directions_lookup(t):
    names = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("direction"), F.col("r_name").alias("direction_destination")
    )
    keyed = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    return joins.enrich(keyed, names, ["c_nationkey"], "inner").select("o_orderkey", "direction", "direction_destination")


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, pm_trip_id, stop_sequence, lag(stop_id) OVER w AS previous_stop_id, lag(vp_move_timestamp) OVER w AS previous_move, lead(vp_move_timestamp) OVER w AS next_move
FROM rail_events WINDOW w AS (PARTITION BY service_date, pm_trip_id ORDER BY stop_sequence)
""")
def self_join_prev_next(t):
    linked = metrics.trip_neighbours(
        rail_events(t),
        ["service_date", "pm_trip_id"],
        ["stop_sequence"],
        {
            "previous_stop_id": ("previous", "stop_id"),
            "previous_move": ("previous", "vp_move_timestamp"),
            "next_move": ("next", "vp_move_timestamp"),
        },
    )
    return linked.select("service_date", "pm_trip_id", "stop_sequence", "previous_stop_id", "previous_move", "next_move")


@query("""
SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'O')
""")
def anti_new_records(t):
    from tramline.operators.groups import anti

    published = t.orders.filter(F.col("o_orderstatus") != "O").select(F.col("o_orderkey").alias("l_orderkey"))
    return anti(t.lineitem, published, ["l_orderkey"]).select("l_orderkey", "l_partkey", F.col("l_linenumber").cast("long"))


@query(f"""
WITH {RAIL_EVENTS},
bus AS (SELECT service_date, pm_trip_id AS trip_id, route_id, stop_sequence FROM rail_events WHERE vp_stop_timestamp IS NOT NULL),
lost AS (SELECT DISTINCT service_date, trip_id, route_id FROM (SELECT service_date, pm_trip_id AS trip_id, route_id, stop_sequence FROM rail_events WHERE tu_stop_timestamp IS NOT NULL AND vp_move_timestamp IS NOT NULL)
  EXCEPT SELECT service_date, trip_id, route_id FROM bus),
gone AS (SELECT DISTINCT s.service_date, s.pm_trip_id AS trip_id FROM rail_events s WHERE tu_stop_timestamp IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bus b WHERE b.service_date = s.service_date
  AND b.trip_id = s.pm_trip_id AND b.stop_sequence = s.stop_sequence))
SELECT service_date, trip_id, stop_sequence FROM bus WHERE (service_date, trip_id) NOT IN (SELECT (service_date, trip_id) FROM gone)
  AND (service_date, trip_id, route_id) NOT IN (SELECT (service_date, trip_id, route_id) FROM lost)
""")
def preserve_all_trips(t):
    e = rail_events(t).withColumnRenamed("pm_trip_id", "t").drop("trip_id").withColumnRenamed("t", "trip_id")
    bus = e.filter(F.col("vp_stop_timestamp").isNotNull())
    predicted = e.filter(F.col("tu_stop_timestamp").isNotNull())
    keys = ["service_date", "trip_id", "route_id"]
    kept = joins.drop_unpreserved_trips(bus, [predicted.filter(F.col("vp_move_timestamp").isNotNull())], keys)
    kept = joins.drop_trips_with_lost_events(kept, predicted, ["service_date", "trip_id", "stop_sequence"], ["service_date", "trip_id"])
    return kept.select("service_date", "trip_id", "stop_sequence")


@query(f"""
WITH {_FEEDS_SQL}, dates AS (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
ranked AS (SELECT d, static_version_key, created_on, epoch_us(CAST(active AS TIMESTAMP)) // 1000000 AS ts FROM dates JOIN feeds ON active < d AND d BETWEEN s AND e)
SELECT strftime(d, '%Y-%m-%d') AS service_date, max(ts) AS effective_timestamp, arg_max('Fall ' || created_on, (ts, 'Fall ' || created_on)) AS rating FROM ranked GROUP BY d
""")
def range_expand_join(t):
    feeds = feed_versions(t).select(
        F.unix_timestamp(times.int_date(F.col("feed_active_date")).cast("timestamp")).alias("timestamp"),
        "feed_start_date",
        "feed_end_date",
        F.concat(F.lit("Fall "), F.col("created_on").cast("string")).alias("feed_version"),
    )
    found = calendar.effective_versions(feeds, "1996-01-01", "2000-12-31")
    return found.select(
        text(F.col("service_date")).alias("service_date"), "effective_timestamp", F.concat_ws(" ", "rating_season", "rating_year").alias("rating")
    )


@query(f"""
WITH {RAIL_EVENTS},
vp AS (SELECT * FROM rail_events WHERE vp_move_timestamp IS NOT NULL OR vp_stop_timestamp IS NOT NULL), tu AS (SELECT * FROM rail_events WHERE tu_stop_timestamp IS NOT NULL)
SELECT service_date, route_id, trip_id, parent_station, vp.vp_move_timestamp, vp.vp_stop_timestamp, tu.tu_stop_timestamp,
  coalesce(vp.vehicle_label, 'tu') AS vehicle_label FROM vp FULL JOIN tu USING (service_date, route_id, trip_id, parent_station)
""")
def outer_merge_events(t):
    e = rail_events(t).withColumn("vehicle_consist", F.lit(None).cast("string"))
    vp = e.filter(F.col("vp_move_timestamp").isNotNull() | F.col("vp_stop_timestamp").isNotNull())
    tu = e.filter(F.col("tu_stop_timestamp").isNotNull()).withColumn("vehicle_label", F.lit("tu")).withColumn(
        "stop_sequence", F.lit(None).cast("long")
    )
    merged = joins.outer_merge_events(
        vp, tu, ["service_date", "route_id", "trip_id", "parent_station"], ["stop_sequence", "vehicle_label", "vehicle_consist"]
    )
    return merged.select(
        "service_date", "route_id", "trip_id", "parent_station", "vp_move_timestamp", "vp_stop_timestamp", "tu_stop_timestamp", "vehicle_label"
    )
