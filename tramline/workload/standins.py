"""Transit notions played by the driver's tables, in Spark and in SQL.

=====================  ==========================================================
trip and vehicle       ``events.user_id``, within a week (the service date)
status                 click, purchase: stopped; view: incoming; others: moving
stop sequence          day of the week plus a step from the event id, so that a
                       share of the records comes out of order
schedule               ``orders`` are trips, ``lineitem`` rows are their stop times
stops, lines           ``supplier``, ``nation``, ``region``
=====================  ==========================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.workload.registry import Tables

# Routes handed out by user number.
ROUTES = ("Red", "Orange", "Blue", "Green-B", "Green-C", "Green-D", "Green-E", "Mattapan", "39", "CR-Line")
_ROUTES_SQL = "[" + ", ".join(f"'{r}'" for r in ROUTES) + "]"


def epoch(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


def positions(t: Tables) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    week = F.to_date(F.date_trunc("week", "ts"))
    seq = (F.datediff(F.to_date("ts"), week) + event % 3 + 1).cast("long")
    suffix = F.when(user % 11 == 0, "-OL1").when(user % 13 == 0, "_2").otherwise("")
    stop_num = 70085 + (seq * 2 + user % 3) % 24
    return t.events.select(
        week.alias("service_date"),
        user.alias("user_id"),
        F.concat(F.lit("T"), user.cast("string"), suffix).alias("trip_id"),
        F.concat(F.lit("y"), (user % 40).cast("string")).alias("vehicle_id"),
        F.concat(F.lit("1"), F.lpad((user % 400).cast("string"), 3, "0")).alias("vehicle_label"),
        F.element_at(F.array(*[F.lit(r) for r in ROUTES]), (user % 10 + 1).cast("int")).alias("route_id"),
        (F.floor(user / 10) % 2).cast("long").alias("direction_id"),
        seq.alias("stop_sequence"),
        stop_num.cast("string").alias("stop_id"),
        F.concat(F.lit("place-"), F.floor((stop_num - 70085) / 2).cast("string")).alias("parent_station"),
        F.when(F.col("event_type").isin("click", "purchase"), "STOPPED_AT")
        .when(F.col("event_type") == "view", "INCOMING_AT")
        .otherwise("IN_TRANSIT_TO")
        .alias("current_status"),
        F.concat(
            F.lpad((5 + user % 21).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad((user % 60).cast("string"), 2, "0"),
            F.lit(":00"),
        ).alias("start_time"),
        ts.alias("vehicle_timestamp"),
        F.unix_timestamp(ts).alias("epoch"),
        (42 + F.col("value") / 1000).alias("latitude"),
        (-71 - F.col("value") / 1000).alias("longitude"),
        event.alias("event_id"),
        F.col("event_type"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


POSITIONS = f"""
base AS (
  SELECT *, CAST(date_trunc('week', ts) AS DATE) AS service_date,
    CAST(date_diff('day', CAST(date_trunc('week', ts) AS DATE), CAST(ts AS DATE)) + event_id % 3 + 1 AS BIGINT) AS stop_sequence
  FROM events),
positions AS (
  SELECT service_date, user_id,
    'T' || user_id || CASE WHEN user_id % 11 = 0 THEN '-OL1' WHEN user_id % 13 = 0 THEN '_2' ELSE '' END AS trip_id,
    'y' || (user_id % 40) AS vehicle_id,
    '1' || lpad(CAST(user_id % 400 AS VARCHAR), 3, '0') AS vehicle_label,
    {_ROUTES_SQL}[user_id % 10 + 1] AS route_id,
    (user_id // 10) % 2 AS direction_id,
    stop_sequence,
    CAST(70085 + (stop_sequence * 2 + user_id % 3) % 24 AS VARCHAR) AS stop_id,
    'place-' || (((stop_sequence * 2 + user_id % 3) % 24) // 2) AS parent_station,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'STOPPED_AT'
         WHEN event_type = 'view' THEN 'INCOMING_AT' ELSE 'IN_TRANSIT_TO' END AS current_status,
    lpad(CAST(5 + user_id % 21 AS VARCHAR), 2, '0') || ':' || lpad(CAST(user_id % 60 AS VARCHAR), 2, '0') || ':00' AS start_time,
    ts AS vehicle_timestamp,
    epoch_us(ts) // 1000000 AS epoch,
    42 + value / 1000 AS latitude, -71 - value / 1000 AS longitude,
    event_id, event_type, value, CAST(props ->> '$.k' AS BIGINT) AS k
  FROM base)"""


def rail_events(t: Tables) -> DataFrame:
    """Stop events of the rail model: one row per trip and station."""
    p = positions(t)
    at = F.col("epoch")
    return p.groupBy(
        F.date_format("service_date", "yyyyMMdd").cast("long").alias("service_date"),
        F.col("user_id").alias("pm_trip_id"),
        "trip_id",
        "route_id",
        "direction_id",
        "stop_sequence",
        "stop_id",
        "parent_station",
        "vehicle_label",
    ).agg(
        F.min(F.when(F.col("event_type").isin("view", "error"), at)).alias("vp_move_timestamp"),
        F.min(F.when(F.col("event_type").isin("click", "purchase"), at)).alias("vp_stop_timestamp"),
        F.max(F.when(F.col("event_type") == "signup", at)).alias("tu_stop_timestamp"),
    )


RAIL_EVENTS = f"""{POSITIONS},
rail_events AS (
  SELECT CAST(strftime(service_date, '%Y%m%d') AS BIGINT) AS service_date, user_id AS pm_trip_id, trip_id, route_id,
    direction_id, stop_sequence, stop_id, parent_station, vehicle_label,
    min(epoch) FILTER (event_type IN ('view', 'error')) AS vp_move_timestamp,
    min(epoch) FILTER (event_type IN ('click', 'purchase')) AS vp_stop_timestamp,
    max(epoch) FILTER (event_type = 'signup') AS tu_stop_timestamp
  FROM positions GROUP BY ALL)"""


def stop_times(t: Tables) -> DataFrame:
    """Scheduled stops from order lines; the line's part breaks ties of its number."""
    arrival = 21600 + F.col("l_linenumber") * 300 + F.col("l_quantity").cast("long") * 7
    return t.lineitem.select(
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_linenumber").cast("long").alias("stop_sequence"),
        F.col("l_suppkey").alias("stop_id"),
        F.col("l_partkey").alias("part"),
        arrival.cast("long").alias("arrival_seconds"),
        (arrival + F.col("l_partkey") % 60).cast("long").alias("departure_seconds"),
        F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")).alias("checkpoint_id"),
    )


STOP_TIMES = """
stop_times AS (
  SELECT l_orderkey AS trip_id, CAST(l_linenumber AS BIGINT) AS stop_sequence, l_suppkey AS stop_id, l_partkey AS part,
    21600 + l_linenumber * 300 + CAST(l_quantity AS BIGINT) * 7 AS arrival_seconds,
    21600 + l_linenumber * 300 + CAST(l_quantity AS BIGINT) * 7 + l_partkey % 60 AS departure_seconds,
    CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS checkpoint_id
  FROM lineitem)"""


def trips(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_orderpriority").alias("route_id"),
        F.col("o_orderstatus").alias("service_id"),
        (F.col("o_orderkey") % 2).alias("direction_id"),
        F.col("o_custkey").alias("block_id"),
        F.year("o_orderdate").cast("long").alias("static_version_key"),
    )


TRIPS = """
trips AS (
  SELECT o_orderkey AS trip_id, o_orderpriority AS route_id, o_orderstatus AS service_id, o_orderkey % 2 AS direction_id,
    o_custkey AS block_id, year(o_orderdate) AS static_version_key
  FROM orders)"""


def text(date: Column) -> Column:
    """Dates leave queries as ISO text, so both engines agree on the type."""
    return F.date_format(date, "yyyy-MM-dd")


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
