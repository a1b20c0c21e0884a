"""Exports of the rail tables, written and brought up to date (section 2.2 of the inventory)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.times import date_int
from tramline.plans import exports, extracts, rail
from tramline.session import scratch_path
from tramline.sources import event_bus
from tramline.workload.jobs import _measured, _routes
from tramline.workload.registry import query
from tramline.workload.standins import POSITIONS, clock_text, positions, text
from tramline.workload.windows import _COUNTED_SQL


def _grown(t, name: str, table: DataFrame, first: Column, mark: str) -> DataFrame:
    """The export after two updates: of some rows, then of all rows with ``mark`` told apart.

    Dates and clocks leave as text and narrow integers as long ones, so both engines agree on the types.
    """
    path = scratch_path(t.spark, name)
    exports.update(t.spark, name, table.filter(first), path)
    exports.update(t.spark, name, table.withColumn(mark, F.concat(F.col(mark), F.lit("*"))), path)
    out = exports.stored(t.spark, name, path).latest()
    kinds = {f.name: f.dataType.simpleString() for f in out.schema.fields}

    def plain(name: str, kind: str) -> Column:
        col = F.col(name)
        if kind == "date":
            return text(col)
        if kind == "timestamp_ntz":
            return clock_text(col)
        return col.cast("long") if kind in ("tinyint", "smallint", "int") else col

    return out.select(*[plain(c, k).alias(c) for c, k in kinds.items()])


def _day(column: str) -> str:
    """SQL: ``YYYYMMDD`` number -> ISO text."""
    return f"strftime(strptime(CAST({column} AS VARCHAR), '%Y%m%d'), '%Y-%m-%d')"


def _local(column: str) -> str:
    """SQL: epoch -> local wall clock (the given events lie in winter)."""
    return f"strftime(make_timestamp(({column} - 18000) * 1000000), '%Y-%m-%d %H:%M:%S')"


def _recent(column: str) -> str:
    """SQL: a mark on rows from the day before the newest on."""
    return f"CASE WHEN service_date >= (SELECT max(service_date) FROM positions) - 1 THEN {column} || '*' ELSE {column} END"


def _trips(t) -> DataFrame:
    """Trips that sent a position while they moved."""
    week = date_int(F.col("service_date"))
    seen = positions(t).filter(F.col("event_type") == "view")
    return seen.groupBy((week * 1000000 + F.col("user_id")).alias("pm_trip_id"), week.alias("service_date"), "trip_id", "route_id", "direction_id", "vehicle_id", "vehicle_label").agg(
        F.count("*").alias("stop_count")
    )


@query(f"""
WITH {POSITIONS}, trips AS (SELECT DISTINCT service_date, user_id FROM positions WHERE event_type = 'view')
SELECT event_id AS pm_event_id, strftime(p.service_date, '%Y-%m-%d') AS service_date, CAST(strftime(p.service_date, '%Y%m%d') AS BIGINT) * 1000000 + p.user_id AS pm_trip_id,
  {_recent("stop_id").replace("service_date >=", "p.service_date >=")} AS stop_id, stop_sequence, CAST(NULL AS BIGINT) AS canonical_stop_sequence, stop_sequence AS sync_stop_sequence, parent_station,
  CAST(NULL AS BIGINT) AS previous_trip_stop_pm_event_id, CAST(NULL AS BIGINT) AS next_trip_stop_pm_event_id,
  CASE WHEN event_type IN ('view', 'error') THEN {_local("epoch")} END AS vp_move_timestamp, CASE WHEN event_type IN ('click', 'purchase') THEN {_local("epoch")} END AS vp_stop_timestamp,
  CASE WHEN event_type = 'signup' THEN {_local("epoch")} END AS tu_stop_timestamp, CAST(NULL AS BIGINT) AS travel_time_seconds, k AS dwell_time_seconds, CAST(NULL AS BIGINT) AS headway_trunk_seconds,
  CAST(NULL AS BIGINT) AS headway_branch_seconds, CAST(NULL AS VARCHAR) AS updated_on
FROM positions p JOIN trips USING (service_date, user_id)
""")
def export_vehicle_events(t):
    at = F.col("epoch")
    events = positions(t).select(
        F.col("event_id").alias("pm_event_id"),
        (date_int(F.col("service_date")) * 1000000 + F.col("user_id")).alias("pm_trip_id"),
        "stop_id", "stop_sequence", F.col("stop_sequence").alias("sync_stop_sequence"), "parent_station",
        F.when(F.col("event_type").isin("view", "error"), at).alias("vp_move_timestamp"),
        F.when(F.col("event_type").isin("click", "purchase"), at).alias("vp_stop_timestamp"),
        F.when(F.col("event_type") == "signup", at).alias("tu_stop_timestamp"),
        F.col("k").alias("dwell_time_seconds"),
    )
    return _grown(t, "vehicle_events", exports.events_of_trips(events, _trips(t)), F.lit(True), "stop_id")


@query(f"""
WITH {POSITIONS}
SELECT CAST(strftime(service_date, '%Y%m%d') AS BIGINT) * 1000000 + user_id AS pm_trip_id, direction_id = 1 AS direction_id, route_id, CAST(NULL AS VARCHAR) AS branch_route_id, CAST(NULL AS VARCHAR) AS trunk_route_id,
  strftime(service_date, '%Y-%m-%d') AS service_date, CAST(NULL AS BIGINT) AS start_time, vehicle_id, count(*) AS stop_count, trip_id, {_recent("vehicle_label")} AS vehicle_label, CAST(NULL AS VARCHAR) AS vehicle_consist,
  CAST(NULL AS VARCHAR) AS direction, CAST(NULL AS VARCHAR) AS direction_destination, CAST(NULL AS BOOLEAN) AS revenue, CAST(NULL AS VARCHAR) AS static_trip_id_guess, CAST(NULL AS BIGINT) AS static_start_time,
  CAST(NULL AS BIGINT) AS static_stop_count, CAST(NULL AS BOOLEAN) AS first_last_station_match, CAST(NULL AS BIGINT) AS static_version_key, CAST(NULL AS VARCHAR) AS updated_on
FROM positions WHERE event_type = 'view' GROUP BY positions.service_date, user_id, direction_id, route_id, vehicle_id, vehicle_label, trip_id
""")
def export_vehicle_trips(t):
    return _grown(t, "vehicle_trips", _trips(t), F.lit(True), "vehicle_label")


_LAST = 1996  # versions up to this one are exported first
_VERSIONED = "CASE WHEN year(o_orderdate) > 1996 THEN {0} || '*' ELSE {0} END"


@query("""
SELECT o_orderpriority AS route_id, o_orderstatus || '*' AS service_id, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS service_date, strftime(o_orderdate, '%Y-%m-%d') AS service_date_calc,
  year(o_orderdate) AS static_version_key FROM (SELECT DISTINCT o_orderpriority, o_orderstatus, o_orderdate FROM orders)
""")
def export_service_id_by_date_and_route(t):
    table = t.orders.select(
        F.col("o_orderpriority").alias("route_id"), F.col("o_orderstatus").alias("service_id"), date_int(F.to_date("o_orderdate")).alias("service_date"),
        F.year("o_orderdate").cast("long").alias("static_version_key"),
    ).distinct()
    return _grown(t, "service_id_by_date_and_route", table, F.col("static_version_key") <= _LAST, "service_id")


@query(f"""
SELECT o_orderkey AS pk_id, o_orderpriority AS route_id, CAST(NULL AS VARCHAR) AS branch_route_id, substr(o_orderpriority, 3) AS trunk_route_id, {_VERSIONED.format("o_orderstatus")} AS service_id,
  CAST(o_orderkey AS VARCHAR) AS trip_id, o_orderkey % 2 AS direction_id, CAST(o_custkey AS VARCHAR) AS block_id, year(o_orderdate) AS static_version_key FROM orders
""")
def export_static_trips(t):
    table = t.orders.select(
        F.col("o_orderkey").alias("pk_id"), F.col("o_orderpriority").alias("route_id"), F.substring("o_orderpriority", 3, 99).alias("trunk_route_id"), F.col("o_orderstatus").alias("service_id"),
        F.col("o_orderkey").alias("trip_id"), (F.col("o_orderkey") % 2).alias("direction_id"), F.col("o_custkey").alias("block_id"), F.year("o_orderdate").cast("long").alias("static_version_key"),
    )
    return _grown(t, "static_trips", table, F.col("static_version_key") <= _LAST, "service_id")


@query("""
SELECT s_suppkey AS pk_id, CAST(s_suppkey AS VARCHAR) AS stop_id, CASE WHEN s_nationkey > 12 THEN s_name || '*' ELSE s_name END AS stop_name, CAST(NULL AS VARCHAR) AS stop_desc, CAST(NULL AS VARCHAR) AS platform_code,
  CAST(NULL AS VARCHAR) AS platform_name, 'place-' || s_nationkey AS parent_station, CAST(s_nationkey AS BIGINT) AS static_version_key FROM supplier
""")
def export_static_stops(t):
    table = t.supplier.select(
        F.col("s_suppkey").alias("pk_id"), F.col("s_suppkey").alias("stop_id"), F.col("s_name").alias("stop_name"), F.concat(F.lit("place-"), F.col("s_nationkey").cast("string")).alias("parent_station"),
        F.col("s_nationkey").alias("static_version_key"),
    )
    return _grown(t, "static_stops", table, F.col("static_version_key") <= 12, "stop_name")


_DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


@query(f"""
SELECT c_custkey AS pk_id, CASE WHEN c_nationkey > 12 THEN c_mktsegment || '*' ELSE c_mktsegment END AS service_id, {", ".join(f"(c_custkey + {i}) % 3 = 0 AS {d}" for i, d in enumerate(_DAYS))},
  '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS start_date, CASE WHEN c_acctbal >= 0 THEN '2024-06-30' END AS end_date, CAST(c_nationkey AS BIGINT) AS static_version_key FROM customer
""")
def export_static_calendar(t):
    key = F.col("c_custkey")
    table = t.customer.select(
        key.alias("pk_id"), F.col("c_mktsegment").alias("service_id"), *[((key + i) % 3 == 0).alias(d) for i, d in enumerate(_DAYS)], (key % 28 + 20240101).alias("start_date"),
        F.when(F.col("c_acctbal") >= 0, 20240630).otherwise(99999999).alias("end_date"), F.col("c_nationkey").alias("static_version_key"),
    )
    return _grown(t, "static_calendar", table, F.col("static_version_key") <= 12, "service_id")


@query(f"""
SELECT o_orderkey AS pk_id, o_orderstatus AS service_id, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date, strftime(o_orderdate, '%Y-%m-%d') AS calendar_date, o_orderkey % 2 + 1 AS exception_type,
  {_VERSIONED.format("o_orderpriority")} AS holiday_name, year(o_orderdate) AS static_version_key FROM orders
""")
def export_static_calendar_dates(t):
    table = t.orders.select(
        F.col("o_orderkey").alias("pk_id"), F.col("o_orderstatus").alias("service_id"), date_int(F.to_date("o_orderdate")).alias("date"), (F.col("o_orderkey") % 2 + 1).alias("exception_type"),
        F.col("o_orderpriority").alias("holiday_name"), F.year("o_orderdate").cast("long").alias("static_version_key"),
    )
    return _grown(t, "static_calendar_dates", table, F.col("static_version_key") <= _LAST, "holiday_name")


@query("""
SELECT p_partkey AS pk_id, p_brand AS route_id, CAST(1 AS BIGINT) AS agency_id, CAST(p_partkey AS VARCHAR) AS route_short_name, CASE WHEN p_size > 25 THEN p_name || '*' ELSE p_name END AS route_long_name, p_type AS route_desc,
  p_partkey % 5 AS route_type, p_partkey AS route_sort_order, CAST(NULL AS VARCHAR) AS route_fare_class, CAST(NULL AS VARCHAR) AS line_id, CAST(p_size AS BIGINT) AS static_version_key FROM part
""")
def export_static_routes(t):
    table = t.part.select(
        F.col("p_partkey").alias("pk_id"), F.col("p_brand").alias("route_id"), F.lit(1).alias("agency_id"), F.col("p_partkey").alias("route_short_name"), F.col("p_name").alias("route_long_name"),
        F.col("p_type").alias("route_desc"), (F.col("p_partkey") % 5).alias("route_type"), F.col("p_partkey").alias("route_sort_order"), F.col("p_size").alias("static_version_key"),
    )
    return _grown(t, "static_routes", table, F.col("static_version_key") <= 25, "route_long_name")


@query(f"""
SELECT min(o_orderkey) AS pk_id, strftime(min(o_orderdate), '%Y-%m-%d') AS feed_start_date, strftime(max(o_orderdate), '%Y-%m-%d') AS feed_end_date, {_VERSIONED.format("any_value(o_orderstatus)").replace("year(o_orderdate)", "year(min(o_orderdate))")} AS feed_version,
  strftime(min(o_orderdate), '%Y-%m-%d') AS feed_active_date, year(min(o_orderdate)) AS static_version_key FROM orders GROUP BY o_orderstatus, year(o_orderdate), month(o_orderdate)
""")
def export_static_feed_info(t):
    day = date_int(F.to_date("o_orderdate"))
    table = t.orders.groupBy(F.col("o_orderstatus").alias("feed_version"), F.year("o_orderdate").cast("long").alias("static_version_key"), F.month("o_orderdate")).agg(
        F.min("o_orderkey").alias("pk_id"), F.min(day).alias("feed_start_date"), F.max(day).alias("feed_end_date"), F.min(day).alias("feed_active_date")
    )
    return _grown(t, "static_feed_info", table, F.col("static_version_key") <= _LAST, "feed_version")


@query("""
SELECT l_orderkey * 10 + l_linenumber AS pk_id, CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(21600 + l_linenumber * 300 AS BIGINT) AS arrival_time, CAST(21660 + l_linenumber * 300 AS BIGINT) AS departure_time, CAST(NULL AS BIGINT) AS schedule_travel_time_seconds,
  CAST(NULL AS BIGINT) AS schedule_headway_trunk_seconds, CAST(NULL AS BIGINT) AS schedule_headway_branch_seconds, CASE WHEN year(l_shipdate) > 1996 THEN l_suppkey || '*' ELSE CAST(l_suppkey AS VARCHAR) END AS stop_id,
  CAST(l_linenumber AS BIGINT) AS stop_sequence, year(l_shipdate) AS static_version_key FROM lineitem
""")
def export_static_stop_times(t):
    line = F.col("l_linenumber")
    table = t.lineitem.select(
        (F.col("l_orderkey") * 10 + line).alias("pk_id"), F.col("l_orderkey").alias("trip_id"), (21600 + line * 300).alias("arrival_time"), (21660 + line * 300).alias("departure_time"),
        F.col("l_suppkey").cast("string").alias("stop_id"), line.alias("stop_sequence"), F.year("l_shipdate").cast("long").alias("static_version_key"),
    )
    return _grown(t, "static_stop_times", table, F.col("static_version_key") <= _LAST, "stop_id")


@query(f"""
WITH {_COUNTED_SQL}, plan AS (SELECT trip_id, stop_sequence, min(k) AS k FROM positions WHERE event_type = 'view' GROUP BY 1, 2),
linked AS (SELECT *, lag(stop_id) OVER w AS previous_stop_id FROM counted WINDOW w AS (PARTITION BY service_date, route_id, trip_id ORDER BY stop_sequence, parent_station))
SELECT {_day("service_date")} AS service_date, l.trip_id, l.stop_sequence, parent_station, previous_stop_id, strftime(strptime(CAST(service_date AS VARCHAR), '%Y%m%d') + INTERVAL 1 SECOND * k, '%Y-%m-%d %H:%M:%S') AS scheduled_arrival_time,
  strftime(strptime(CAST(service_date AS VARCHAR), '%Y%m%d') + INTERVAL 1 SECOND * (k + 30), '%Y-%m-%d %H:%M:%S') AS scheduled_departure_time, k AS scheduled_travel_time, k + 1 AS scheduled_headway_branch, k + 2 AS scheduled_headway_trunk
FROM linked l LEFT JOIN plan p ON l.trip_id = p.trip_id AND l.stop_sequence = p.stop_sequence WHERE route_id = 'CR-Line' AND (vp_move_timestamp IS NOT NULL OR vp_stop_timestamp IS NOT NULL)
""")
def rail_wide_commuter(t):
    k = F.col("k")
    plan = positions(t).filter(F.col("event_type") == "view").groupBy("trip_id", "stop_sequence").agg(F.min("k").alias("k")).select(
        F.lit(1).alias("static_version_key"), "trip_id", "stop_sequence", k.alias("arrival_seconds"), (k + 30).alias("departure_seconds"), k.alias("schedule_travel_time_seconds"),
        (k + 1).alias("schedule_headway_branch_seconds"), (k + 2).alias("schedule_headway_trunk_seconds"),
    )
    stops = positions(t).select("stop_id").distinct().select(F.lit(1).alias("static_version_key"), "stop_id", F.col("stop_id").alias("stop_name"))
    wide = rail.rail_wide_table(_measured(t), stops, _routes(t), (2,), plan)
    return wide.select(
        text(F.col("service_date")).alias("service_date"), "trip_id", "stop_sequence", "parent_station", "previous_stop_id", clock_text(F.col("scheduled_arrival_time")).alias("scheduled_arrival_time"),
        clock_text(F.col("scheduled_departure_time")).alias("scheduled_departure_time"), "scheduled_travel_time", "scheduled_headway_branch", "scheduled_headway_trunk",
    )


def _records(t) -> DataFrame:
    """Event-bus records with times and dates, some of which do not parse."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entered = F.struct(F.when(F.col("k") > 10, stamp).otherwise("soon").alias("inputTimestamp"))
    day = F.date_format("ts", "yyyy-MM-dd")
    key = F.struct(F.when(F.col("k") > 20, day).otherwise("2024-13-01").alias("serviceDate"))
    update = F.struct(F.lit("u").alias("type"), key.alias("tripKey"), F.struct(day.alias("serviceDate")).alias("previousTripKey"))
    operator = F.struct(F.col("user_id").cast("string").alias("badgeNumber"))
    data = F.when(F.col("event_type") == "click", F.to_json(F.struct(entered.alias("metadata"), operator.alias("operator"), stamp.alias("signedInAt")))).otherwise(
        F.to_json(F.struct(entered.alias("metadata"), F.array(update, update).alias("tripUpdates")))
    )
    value = F.concat(F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('","type":"t","time":"'), stamp, F.lit('","source":"s","specversion":"1.0","data":'), data, F.lit("}"))
    return event_bus.route_records(t.events.withColumn("k", F.get_json_object("props", "$.k").cast("long")).select(value.alias("value")))


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS time, CASE WHEN CAST(props ->> '$.k' AS BIGINT) > 10 THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') END AS entered,
  strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS signed_in, CAST(user_id AS VARCHAR) AS badge FROM events WHERE event_type = 'click'
""")
def event_bus_sign_ins_extract(t):
    table = extracts.event_bus_extract(event_bus.typed_table(_records(t), "operator_sign_ins"), "operator_sign_ins")
    return table.select(
        "id", clock_text(F.col("time")).alias("time"), clock_text(F.col("data_metadata_inputTimestamp")).alias("entered"), clock_text(F.col("data_signedInAt")).alias("signed_in"),
        F.col("data_operator_badgeNumber").alias("badge"),
    )


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS time, CASE WHEN CAST(props ->> '$.k' AS BIGINT) > 10 THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') END AS entered,
  CASE WHEN CAST(props ->> '$.k' AS BIGINT) > 20 THEN strftime(ts, '%Y-%m-%d') END AS service_date, strftime(ts, '%Y-%m-%d') AS previous_service_date
FROM events, range(2) WHERE event_type <> 'click'
""")
def event_bus_trip_updates_extract(t):
    table = extracts.event_bus_extract(event_bus.typed_table(_records(t), "trip_updates"), "trip_updates")
    return table.select(
        "id", clock_text(F.col("time")).alias("time"), clock_text(F.col("data_metadata_inputTimestamp")).alias("entered"), text(F.col("data_tripUpdates_tripKey_serviceDate")).alias("service_date"),
        text(F.col("data_tripUpdates_previousTripKey_serviceDate")).alias("previous_service_date"),
    )
