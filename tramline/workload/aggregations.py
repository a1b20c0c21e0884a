"""Aggregations (section 2.5 of the inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators import aggregates, calendar, events, filters
from tramline.workload.registry import query
from tramline.workload.standins import POSITIONS, RAIL_EVENTS, STOP_TIMES, TRIPS, positions, rail_events, stop_times, text, trips

_KEPT_SQL = f"""{POSITIONS},
kept AS (SELECT *EXCLUDE (current_status), CASE WHEN current_status = 'INCOMING_AT' THEN 'IN_TRANSIT_TO' ELSE current_status END AS current_status FROM (
  SELECT *, min(stop_sequence) OVER (PARTITION BY service_date, trip_id, vehicle_label ORDER BY vehicle_timestamp, stop_sequence
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lowest FROM positions) WHERE stop_sequence <= lowest),
bus_events AS (SELECT service_date, trip_id, vehicle_label, vehicle_id, route_id, direction_id, stop_id, stop_sequence AS gtfs_stop_sequence,
    CAST(substr(start_time, 1, 2) AS BIGINT) * 3600 + CAST(substr(start_time, 4, 2) AS BIGINT) * 60 AS start_time,
    min(vehicle_timestamp) FILTER (current_status = 'IN_TRANSIT_TO') AS first_in_transit,
    least(max(vehicle_timestamp) FILTER (current_status = 'IN_TRANSIT_TO'), min(vehicle_timestamp) FILTER (current_status = 'STOPPED_AT')) AS last_in_transit,
    min(vehicle_timestamp) FILTER (current_status = 'STOPPED_AT') AS arrival,
    max(vehicle_timestamp) FILTER (current_status = 'STOPPED_AT') AS departure,
    arg_min(latitude, (vehicle_timestamp, latitude)) AS latitude
  FROM kept GROUP BY ALL)"""


@query(f"""
WITH {_KEPT_SQL}
SELECT strftime(service_date, '%Y-%m-%d') AS service_date, trip_id, vehicle_label, gtfs_stop_sequence, start_time, epoch_us(first_in_transit) // 1000000 AS first_in_transit,
  epoch_us(last_in_transit) // 1000000 AS last_in_transit, epoch_us(arrival) // 1000000 AS arrival, epoch_us(departure) // 1000000 AS departure, round(latitude, 6) AS latitude,
  count(*) OVER (PARTITION BY service_date, trip_id, vehicle_id) AS stop_count
FROM bus_events
""")
def positions_to_events(t):
    found = events.positions_to_events(filters.fold_incoming(positions(t)), stretch_seconds=60)
    return found.select(
        text(F.col("service_date")).alias("service_date"),
        "trip_id",
        "vehicle_label",
        "gtfs_stop_sequence",
        "start_time",
        F.unix_timestamp("gtfs_first_in_transit_dt").alias("first_in_transit"),
        F.unix_timestamp("gtfs_last_in_transit_dt").alias("last_in_transit"),
        F.unix_timestamp("gtfs_arrival_dt").alias("arrival"),
        F.unix_timestamp("gtfs_departure_dt").alias("departure"),
        F.round("latitude", 6).alias("latitude"),
        "stop_count",
    )


@query(f"""
WITH {POSITIONS}
SELECT strftime(service_date, '%Y-%m-%d') AS service_date, route_id, trip_id, parent_station, min(epoch) FILTER (current_status <> 'STOPPED_AT') AS vp_move_timestamp,
  min(epoch) FILTER (current_status = 'STOPPED_AT') AS vp_stop_timestamp, arg_min(event_id, (epoch, event_id)) AS event_id FROM positions GROUP BY ALL
""")
def vp_move_stop_pivot(t):
    moving = positions(t).select(
        "service_date", "route_id", "trip_id", "parent_station", "event_id",
        (F.col("current_status") != "STOPPED_AT").alias("is_moving"), F.col("epoch").alias("vehicle_timestamp"),
    )
    return events.move_stop_pivot(moving, ["event_id"]).withColumn("service_date", text(F.col("service_date")))


@query(f"""
WITH {STOP_TIMES}
SELECT trip_id, count(*) AS stop_count, min(arrival_seconds) AS start_time FROM stop_times GROUP BY 1
""")
def stop_counts(t):
    return aggregates.trip_stop_counts(stop_times(t), ["trip_id"], "arrival_seconds")


@query(f"""
WITH {RAIL_EVENTS}, seen AS (SELECT pm_trip_id, coalesce(min(vp_move_timestamp), min(vp_stop_timestamp), min(tu_stop_timestamp)) AS at0 FROM rail_events GROUP BY 1),
planned AS (SELECT o_custkey AS pm_trip_id, min(o_orderkey) AS p FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT c_custkey AS pm_trip_id, CASE WHEN c_acctbal > 5000 THEN c_custkey ELSE coalesce(p, at0 - (epoch_us(date_trunc('day', make_timestamp(at0 * 1000000) - INTERVAL 9 HOUR)) // 1000000 + 18000)) END AS start_time
FROM customer LEFT JOIN planned ON c_custkey = planned.pm_trip_id LEFT JOIN seen ON c_custkey = seen.pm_trip_id
""")
def start_time_backfill(t):
    known = t.customer.select(
        F.col("c_custkey").alias("pm_trip_id"), F.when(F.col("c_acctbal") > 5000, F.col("c_custkey")).alias("start_time")
    )
    scheduled = t.orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("pm_trip_id"), F.col("o_orderkey").alias("departure_time")
    )
    return aggregates.backfill_start_times(known, scheduled, rail_events(t), ["pm_trip_id"])


@query(f"""
WITH {TRIPS}, tops AS (SELECT route_id, max(static_version_key) AS top FROM trips WHERE service_id = 'O' AND static_version_key < 1999 GROUP BY 1)
SELECT trip_id, coalesce(top, static_version_key) AS static_version_key FROM trips LEFT JOIN tops USING (route_id)
""")
def max_version_per_day(t):
    table = trips(t).select("trip_id", F.col("route_id").alias("service_date"), "static_version_key", "service_id")
    changed = table.filter((F.col("service_id") == "O") & (F.col("static_version_key") < 1999))
    return calendar.max_version_per_day(table.drop("service_id"), changed).select("trip_id", "static_version_key")


_BRANCH_SQL = """seen AS (SELECT service_date, pm_trip_id, route_id, bool_or(CAST(stop_id AS INT) BETWEEN 70085 AND 70094) AS ashmont,
  bool_or(CAST(stop_id AS INT) BETWEEN 70095 AND 70105) AS braintree FROM rail_events GROUP BY ALL)"""


@query(f"""
WITH {RAIL_EVENTS}, {_BRANCH_SQL}
SELECT service_date, pm_trip_id, route_id, CASE WHEN route_id LIKE 'Green%' THEN route_id WHEN route_id = 'Red' AND ashmont THEN 'Red-A' WHEN route_id = 'Red' AND braintree THEN 'Red-B' END AS branch_route_id,
  CASE WHEN route_id LIKE 'Green%' THEN 'Green' ELSE route_id END AS trunk_route_id FROM seen
""")
def branch_trunk(t):
    return aggregates.branch_and_trunk(rail_events(t), ["service_date", "pm_trip_id"])


@query(f"""
WITH {POSITIONS}, feed AS (SELECT trip_id, stop_sequence, event_type, epoch AS feed_timestamp FROM positions)
SELECT * FROM feed WHERE feed_timestamp < 1705276800 - 2700
UNION ALL SELECT trip_id, stop_sequence, event_type, min(feed_timestamp) FROM feed WHERE feed_timestamp >= 1705276800 - 2700 GROUP BY ALL
""")
def windowed_dedup(t):
    feed = positions(t).select("trip_id", "stop_sequence", "event_type", F.col("epoch").alias("feed_timestamp"))
    return aggregates.windowed_dedup(feed, 1705276800 - 2700, ["trip_id", "stop_sequence", "event_type"])


_CANON_SQL = f"""{POSITIONS},
canon AS (SELECT CASE WHEN route_id LIKE 'Green%' THEN 'Green' ELSE route_id END AS trunk_route_id, route_id, direction_id, parent_station, stop_sequence
  FROM (SELECT route_id, direction_id, parent_station, min(stop_sequence) AS stop_sequence FROM positions GROUP BY 1, 2, 3)),
zero AS (SELECT trunk_route_id, parent_station FROM (SELECT *, row_number() OVER (PARTITION BY trunk_route_id ORDER BY n DESC, spread DESC, parent_station) AS r FROM (
  SELECT trunk_route_id, parent_station, count(*) AS n, max(stop_sequence) - min(stop_sequence) AS spread FROM canon GROUP BY 1, 2)) WHERE r = 1)"""


def _canon(t):
    trunk = F.when(F.col("route_id").startswith("Green"), "Green").otherwise(F.col("route_id"))
    return positions(t).groupBy("route_id", "direction_id", "parent_station").agg(F.min("stop_sequence").alias("stop_sequence")).select(
        F.lit(1).alias("static_version_key"), trunk.alias("trunk_route_id"), "route_id", "direction_id", "parent_station", "stop_sequence"
    )


@query(f"""
WITH {_CANON_SQL}
SELECT trunk_route_id, parent_station FROM zero
""")
def canonical_zero_point(t):
    return aggregates.zero_points(_canon(t), ["trunk_route_id"])


@query(f"""
WITH {_CANON_SQL},
at_zero AS (SELECT direction_id, route_id, min(stop_sequence) AS z FROM canon JOIN zero USING (trunk_route_id, parent_station) GROUP BY 1, 2),
shifted AS (SELECT c.*, stop_sequence - z AS s FROM canon c JOIN at_zero USING (direction_id, route_id)),
low AS (SELECT direction_id, trunk_route_id, min(stop_sequence) AS min_seq, min(s) AS min_sync FROM shifted GROUP BY 1, 2)
SELECT DISTINCT direction_id, trunk_route_id, parent_station, s - min_sync + min_seq AS sync_stop_sequence FROM shifted JOIN low USING (direction_id, trunk_route_id)
""")
def sync_adjust(t):
    return aggregates.sync_sequences(_canon(t)).drop("static_version_key")


@query(f"""
WITH {RAIL_EVENTS}, {_BRANCH_SQL}, counts AS (SELECT service_date, pm_trip_id, count(*) AS static_stop_count, min(vp_stop_timestamp) AS static_start_time FROM rail_events GROUP BY 1, 2)
SELECT service_date, pm_trip_id, static_stop_count, static_start_time, CASE WHEN route_id = 'Red' THEN CASE WHEN ashmont THEN 'Red-A' ELSE 'Red-B' END ELSE route_id END AS route_id
FROM counts JOIN seen USING (service_date, pm_trip_id)
""")
def static_trip_summary(t):
    from tramline.plans.rail import static_trip_summary as summary

    calls = rail_events(t).select("service_date", "pm_trip_id", "route_id", "stop_id", F.col("vp_stop_timestamp").alias("arrival_seconds"))
    return summary(calls, ["service_date", "pm_trip_id"])


@query(f"""
WITH {POSITIONS}
SELECT strftime(service_date, '%Y-%m-%d') AS service_date, route_id, path, row_number() OVER (PARTITION BY service_date, route_id ORDER BY path) AS position
FROM (SELECT *, lpad(CAST(event_id AS VARCHAR), 12, '0') AS path FROM positions)
""")
def collect_files(t):
    from tramline.sources.manifest import files_by_date

    files = positions(t).select(
        "service_date", F.col("route_id").alias("source"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("path")
    )
    return files_by_date(files).select(
        text(F.col("service_date")).alias("service_date"), F.col("source").alias("route_id"), "path", "position"
    )


@query(f"""
WITH {RAIL_EVENTS}, lags AS (SELECT route_id, abs(vp_stop_timestamp - vp_move_timestamp) AS lag FROM rail_events)
SELECT route_id, quantile_cont(lag, 0.99) AS q99, quantile_cont(lag, 0.5) AS q50 FROM lags WHERE lag IS NOT NULL GROUP BY 1
""")
def event_quantiles(t):
    lags = rail_events(t).select("route_id", F.abs(F.col("vp_stop_timestamp") - F.col("vp_move_timestamp")).alias("lag"))
    return aggregates.exact_quantiles(lags, ["route_id"], "lag", {"q99": 0.99, "q50": 0.5}, width=3600)


@query(f"""
WITH {RAIL_EVENTS}, plausible AS (SELECT service_date, pm_trip_id, stop_sequence, 'arrived' AS kind FROM rail_events WHERE vp_move_timestamp IS NOT NULL
  UNION ALL SELECT service_date, pm_trip_id, stop_sequence, 'departed' FROM rail_events WHERE tu_stop_timestamp IS NOT NULL),
found AS (SELECT service_date, pm_trip_id, stop_sequence, unnest(['arrived', 'departed']) AS kind FROM rail_events WHERE vp_stop_timestamp IS NOT NULL)
SELECT kind, count(*) AS plausible, count(*) FILTER (f.kind IS NULL) AS missing, 1 - count(*) FILTER (f.kind IS NULL) / count(*) AS coverage
FROM plausible p LEFT JOIN found f USING (service_date, pm_trip_id, stop_sequence, kind) GROUP BY kind
""")
def coverage_ratio(t):
    keys = ["service_date", "pm_trip_id", "stop_sequence"]
    e = rail_events(t)
    plausible = e.select(*keys, F.col("vp_move_timestamp").alias("arrived"), F.col("tu_stop_timestamp").alias("departed"))
    found = e.select(*keys, F.col("vp_stop_timestamp").alias("arrived"), F.col("vp_stop_timestamp").alias("departed"))
    return aggregates.coverage_ratio(plausible, found, keys, ["arrived", "departed"]).withColumn(
        "missing", F.col("missing").cast("long")
    )


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, count(DISTINCT trip_id) AS trips FROM rail_events GROUP BY 1
""")
def n_unique_by_date(t):
    return aggregates.distinct_trips_by_date(rail_events(t), "service_date", "trip_id")


@query("""
SELECT strftime(d, '%Y-%m-%d') AS service_date, CAST(lead(d) OVER (ORDER BY d) - d AS BIGINT) AS days_to_next FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
""")
def service_date_gaps(t):
    dates = t.lineitem.select(F.to_date("l_shipdate").alias("service_date"))
    gaps = aggregates.date_gaps(dates, "service_date")
    return gaps.select(text(F.col("service_date")).alias("service_date"), F.col("days_to_next").cast("long"))


@query(f"""
WITH {RAIL_EVENTS}
SELECT service_date, trip_id, coalesce(vp_stop_timestamp, vp_move_timestamp, tu_stop_timestamp) // 3600 AS span, string_agg(stop_sequence || ':' || stop_id, ',' ORDER BY stop_sequence) AS stops FROM rail_events
WHERE coalesce(vp_stop_timestamp, vp_move_timestamp, tu_stop_timestamp) >= 1705276800 GROUP BY 1, 2, 3
""")
def nested_trip_documents(t):
    e = rail_events(t).withColumn("timestamp", F.coalesce("vp_stop_timestamp", "vp_move_timestamp", "tu_stop_timestamp"))
    documents = aggregates.trip_documents(e, ["service_date", "trip_id"], "stop_sequence", ["stop_id"], 1705276800)
    stops = F.array_join(F.transform("stop_events", lambda s: F.concat_ws(":", s["stop_sequence"], s["stop_id"])), ",")
    return documents.select("service_date", "trip_id", "span", stops.alias("stops"))


_ORDER_COLUMNS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM orders"""
    for c in _ORDER_COLUMNS
))
def row_profile(t):
    return aggregates.row_profile(t.orders)
